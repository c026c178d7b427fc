import hashlib
import random

from pyspark.sql import functions as F

from quarry.llm import op02_exact_dedup as op
from quarry.llm.common import A_Z

LOWER = str.maketrans(A_Z, A_Z.lower())


def brute(rows):
    norm = [(i, (t or "").translate(LOWER)) for i, t in rows]
    out = {}
    for i, t in norm:
        same = [j for j, u in norm if u == t]
        keep = max(same, key=lambda j: -2 ** 63 if j is None else j)
        out[i] = (keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest())
    return out


ROWS = [(1, "Hello World"), (2, "hello world"), (3, None), (4, ""), (5, "ÉTÉ"), (6, "été"), (7, "x" * 300_000),
        (8, "X" * 300_000), (9, "only"), (9, "only"), (None, "ONLY")]


def got(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_against_brute_force(spark, make_docs):
    rows = ROWS + [(100 + i, random.Random(i).choice(["a", "b c", "B C", "hot"])) for i in range(200)]
    docs, sf = make_docs(rows)
    assert got(op.query(spark, sf)) == brute(rows)


def test_empty_and_clashing_columns(spark, make_docs):
    docs, _ = make_docs(ROWS)
    wide = docs.withColumns({c: F.lit(7) for c in ("digest", "keep_id", "group_size", "kept", "text_sha256", "_id")})
    assert got(op.exact_dedup(wide)) == brute(ROWS)
    assert op.exact_dedup(docs.limit(0)).count() == 0
    stay = op.keep_rows(wide)
    assert stay.columns == wide.columns
    assert sorted(r.doc_id for r in stay.collect()) == [2, 4, 5, 6, 8, 9]


def test_index_persists_and_grows(spark, make_docs):
    docs, _ = make_docs([(1, "a"), (2, "b")])
    more, _ = make_docs([(3, "A"), (4, "c"), (5, "C")])
    index = op.DigestIndex(spark)
    index.ingest(docs)
    index.drop()
    again = op.DigestIndex(spark, index.path, index.buckets)      # as another session would
    res = got(again.ingest(more))
    assert res[3][0] == 1 and not res[3][2] and res[4][0] == 5 and res[5][2]
    assert again.rows().count() == 3


def test_index_side_is_not_shuffled(spark, make_docs):
    docs, _ = make_docs([(1, "a"), (2, "b")])
    index = op.DigestIndex(spark, buckets=4)
    index.ingest(docs)
    plan = (docs.select(F.unhex(F.sha2("text", 256)).alias("digest")).repartition(4, "digest")
            .join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString())
    assert "SortMergeJoin" in plan and plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") <= 1
