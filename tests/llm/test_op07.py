import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from quarry.llm import common, op07_lm as op
from quarry.llm.common import A_Z

LOW = str.maketrans(A_Z, A_Z.lower())
WORD = re.compile(r"[^\x20\x09-\x0D]+")
held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def brute(docs):
    tokens = [(i, WORD.findall((t or "").translate(LOW)) + [None]) for i, t in docs]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (held(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens}


def check(rows, want):
    for r in rows:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert math.isclose(r.base_score, w[4], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def fixture():
    r = random.Random(1)
    vocab = ["the", "of", "The", "été", "x", "😀"] + [f"w{k}" for k in range(300)]
    docs = [(0, None), (1, ""), (2, " \n"), (3, "the " * 3000), (None, "the of")]
    docs += [(i, r.choice([" ", "\n"]).join(r.choice(vocab) for _ in range(r.randint(0, 80)))) for i in range(4, 90)]
    return docs + [(200, docs[9][1]), (201, docs[9][1])]


def test_query_against_brute_force(spark, make_docs):
    docs = fixture()
    _, sf = make_docs(docs)
    rows = op.query(spark, sf).collect()
    assert len(rows) == len(docs)
    check(rows, brute(docs))


def test_repeated_rows_buckets_and_clashing_columns(spark, make_docs, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_BYTES", 300)
    docs = fixture()
    table, _ = make_docs(docs + [docs[20], docs[20]])
    wide = table.withColumns({c: F.lit(1) for c in ("train", "text_key", "piece", "payload", "model")})
    rows = op.score_texts(wide, ~op.fold("doc_id", 7, 2), vocab=40).withColumn("held_out", op.fold("doc_id", 7, 2)).withColumn("doc_id", common.restore_id()).collect()
    assert len(rows) == len(docs) + 2
    check(rows, brute(docs + [docs[20], docs[20]]))


def test_no_bucket_takes_every_document(spark):
    """Neither the end nor a word of all documents brings them to one bucket."""
    docs = spark.range(0, 4000, 1, 4).select(F.col("id").alias("doc_id"), F.lit("the").alias("text"))
    keyed = common.key_text(docs).withColumns({"text_key": F.xxhash64("text"), "train": F.lit(True)})
    before = spark.conf.get(common.BATCH_ROWS)
    spark.conf.set(common.BATCH_ROWS, "50")
    try:
        asked = keyed.mapInArrow(op.asking(8), op.ASK)
        rows = asked.groupBy("bucket").agg(F.sum(F.length("docs")).alias("ids"), F.sum(F.length("payload")).alias("size")).collect()
    finally:
        spark.conf.set(common.BATCH_ROWS, before)
    assert sum(r.ids for r in rows) == 16 * 4000
    assert max(r.ids for r in rows) < 16 * 4000 / 2


def test_no_training_text_and_empty_table(spark, make_docs):
    ids = [i for i in range(100) if held(i)][:3]
    _, sf = make_docs([(i, "a b") for i in ids])
    rows = op.query(spark, sf).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.n_tokens == 3 and r.base_score == 0 and math.isfinite(r.score) for r in rows)
    _, sf = make_docs([])
    assert op.query(spark, sf).count() == 0


def test_long_texts_in_pieces():
    import pyarrow as pa
    t = " ".join(f"w{k % 13}" for k in range(3_00_000))
    b = pa.RecordBatch.from_pydict({"text": pa.array(["a b", t, "", "c"])})
    got = [(i, len(h), n) for i, h, _, n in op.token_pieces(b)]
    assert sum(x[1] for x in got) == 2 + 300_000 + 0 + 1 + 4 and sum(x[2] for x in got) == 4


def test_model_is_normalised_and_beats_the_base_on_held_out_text(spark):
    sf = "/root/testdata/sf0.01"
    rows = [r for r in op.query(spark, sf).collect() if r.held_out]
    assert len(rows) > 100
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    m = op.LogBilinear(5, 4, dim=3)
    counts = np.array([[5, 0, 1, 0], [0, 90, 2, 1], [30, 1, 1, 1], [1, 1, 80, 1], [2, 2, 2, 2.0]])
    m.train(counts, np.zeros(4) + 1e-9)
    p = 10 ** m.log10(np.arange(5))
    assert np.allclose(p.sum(1), 1)
    assert p[1].argmax() == 1 and p[2].argmax() == 0 and p[3].argmax() == 2


def test_counts_on_fixture_documents(spark):
    docs = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    check(op.query(spark, "/root/testdata/sf0.001").collect(), brute(docs))
