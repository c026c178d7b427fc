import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import by_id
from quarry.llm import op04_language as op

SF = "/root/testdata/sf0.01"
fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet'").fetchall()


def slow_features(chunk):
    """Presence of hashed 1- to 3-grams, gram by gram."""
    t = [int(op.CLEAN[b]) for b in chunk]
    out = set()
    for n in op.GRAMS:
        for a in range(len(t) - n + 1):
            code = 0
            for b in t[a:a + n]:
                code = code << 8 | b
            h = ((code * 0x9E3779B1 % 2 ** 32) ^ (n * 0x15EBCA6B)) * 0xC2B2AE35 % 2 ** 32
            out.add(h >> 17)
    return out


def test_query_held_out_accuracy(spark, docs):
    got = by_id(op.query(spark, SF))
    assert len(got) == len(docs)
    right = [got[i].lang_pred == lang for i, _, lang in docs if fold(i)]
    assert all(got[i].held_out == fold(i) for i, _, _ in docs)
    assert len(right) > 150 and np.mean(right) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_scores_against_plain_kernels(docs):
    sample = [(lang, t.encode()[:op.CHUNK]) for _, t, lang in docs[:60]]
    m = op.Classifier.fit(sample, landmarks=5)
    ordered = sorted(set(sample), key=lambda x: (zlib.crc32(x[1]), x[1], x[0]))
    marks = [slow_features(c) for lab in m.labels for c in [c for lang, c in ordered if lang == lab][:5]]
    texts = [docs[k][1].encode() for k in (70, 71)] + [(docs[72][1] * 5).encode()[:3 * op.CHUNK + 17], b"a"]
    off = np.r_[0, np.cumsum([len(t) for t in texts])]
    got = m.scores(np.frombuffer(b"".join(texts), np.uint8), off)
    for t, s in zip(texts, got):
        chunks = [t[a:a + op.CHUNK] for a in range(0, len(t), op.CHUNK)]
        want = 0
        for c in chunks:
            f = slow_features(c)
            k = np.array([len(f & x) / np.sqrt(len(f) * len(x)) for x in marks])
            want = want + (k @ m.weights[:-1] + m.weights[-1]) * len(c) / len(t)
        assert np.allclose(s, want, atol=1e-3)


def test_defined_cases(spark, make_docs, docs):
    train = [(i, t, lang) for i, t, lang in docs[:150]]
    rows = train + [(5001, None, "en"), (5002, "", "en"), (5003, "123 $$$ .. 9", "en"), (5004, "x", None), (None, "the and", None),
                    (5005, train[0][1] * 300, None), (5006, "日本", None), (train[1][0], train[1][1], train[1][2])]
    table, sf = make_docs(rows)
    got = op.query(spark, sf).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (5001, 5002, 5003)] == ["und"] * 3 and by[5001].score == 0
    assert by[5004].lang_pred != "und" and by[5006].lang_pred != "und" and by[None].held_out is False
    assert by[5005].lang_pred == train[0][2]
    wide = table.withColumns({c: F.lit(1) for c in ("letter", "text_key", "lang_pred", "score", "_id")})
    kept = op.known_language(wide)
    assert kept.columns == wide.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i, _, _ in train} and kept.where("doc_id in (5001, 5002, 5003)").count() == 0


def test_copies_take_no_place_in_the_sample(spark):
    words = [f"word{k} " * 20 for k in range(60)]
    rows = [("aa", w) for w in words[:30]] + [("bb", w) for w in words[30:]] + [("cc", "one")]
    labelled = spark.createDataFrame(rows, "lang string, text string").unionByName(
        spark.range(200_000).select(F.lit("bb").alias("lang"), F.lit(words[30]).alias("text")))
    got = op.training_chunks(labelled, "lang", "text", 20)
    want = {(lang, t.encode()) for lang in ("aa", "bb", "cc")
            for t in sorted({t for x, t in rows if x == lang}, key=lambda t: zlib.crc32(t.encode()))[:20]}
    assert len(got) == len(want) == 41 and set(got) == want


def test_no_labels_and_empty(spark, make_docs):
    table, sf = make_docs([(1, "hello"), (2, "x")])
    assert {r.lang_pred for r in op.query(spark, sf).collect()} == {"und"}
    _, sf = make_docs([])
    assert op.query(spark, sf).count() == 0


def test_labels_of_the_held_out_fold_are_not_used(spark, make_docs, docs):
    rows = [(i, t, lang) for i, t, lang in docs[:200]]
    _, a = make_docs(rows)
    _, b = make_docs([(i, t, "zz" if fold(i) else lang) for i, t, lang in rows])
    key = lambda sf: sorted((r.doc_id, r.lang_pred, round(r.score, 5)) for r in op.query(spark, sf).collect())
    assert key(a) == key(b)
