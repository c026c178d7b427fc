import duckdb
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as cp
from llm_helpers import by_id
from quarry.llm import op03_sentencepiece, op04_language
from test_op02 import brute as equal_texts
from test_op08 import brute as hits
from test_op10 import brute as near

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    lib = sentencepiece.SentencePieceProcessor(model_file=op03_sentencepiece.MODEL_PATH)
    columns, before = docs.columns, rows(docs)
    for name, stage in cp.STAGES:
        out = cp.cut(stage(spark, docs, SF), "test")
        if name == "language":
            told = by_id(op04_language.query(spark, SF))
            want = {i for i, _ in before if told[i].lang_pred != "und" and told[i].score >= op04_language.MIN_SCORE}
        elif name == "exact_dedup":
            want = {i for i, w in equal_texts(before).items() if w[2]}
        elif name == "near_dedup":
            want = {i for i, w in near(before, 5).items() if w[2]}
        elif name == "decontaminate":
            want = {i for i, w in hits(before, items).items() if not w[4]}
        else:
            assert {r.doc_id: r.ids for r in out.collect()} == {i: lib.encode(t) for i, t in before}
            assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out.collect())
            break
        after = rows(out)
        assert out.columns == columns and {i for i, _ in after} == want and len(after) == len(want)
        assert set(after) <= set(before)
        docs, before = out, after
    assert sorted(r.doc_id for r in cp.run(spark, SF).collect()) == sorted(i for i, _ in before)


def test_odd_rows_and_clashing_columns(spark, make_docs):
    text = "the words of this text are told apart by their language because there are enough of them here"
    docs, sf = make_docs([(1, None, "en"), (2, "", "en"), (3, text, "en"), (3, text, "en"), (None, text + " and more", "en"), (4, "123", None)],
                         benchmark=([(1, "never to be found in any text at all")], "item_id long, text string"))
    wide = docs.withColumns({c: F.lit(1) for c in ("_id", "_key", "ids", "keys", "text_key", "component_id", "kept", "starts")})
    out = wide
    for name, stage in cp.STAGES[:-1]:
        out = cp.cut(stage(spark, out, sf), "test")
        assert out.columns == wide.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) in ([0, 3], [0])     # near copies: the null id is the smallest
    assert cp.STAGES[-1][1](spark, out, sf).count() == out.count()
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        empty = cp.cut(stage(spark, empty, sf), "test")
        assert empty.count() == 0
