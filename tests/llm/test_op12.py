import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import families
from quarry.llm import op12_jaccard_join as op
from test_op10 import brute, fixture, low, near_misses


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def want(docs, k=5):
    return {i: w[:2] for i, w in brute(docs, k).items()}


def edited(seed, n=150):
    """Long texts with few edits: similarity around the threshold on 5-word shingles."""
    r = random.Random(seed)
    bases = [[f"w{r.randrange(500)}" for _ in range(r.choice([20, 60, 64, 130, 250]))] for _ in range(10)]
    out = []
    for i in range(n):
        w = list(r.choice(bases))
        for _ in range(r.randint(0, max(1, len(w) // 40))):
            k = r.randrange(len(w))
            w[k:k + 1] = r.choice([[f"x{i}"], [], [w[k], "new"]])
        out.append((1000 + i, " ".join(w[:r.choice([len(w), len(w) * 9 // 10])])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_brute_force(spark, make_docs, seed):
    docs = fixture(seed) + edited(seed)
    _, sf = make_docs(docs)
    assert got(op.query(spark, sf)) == want(docs)


def test_small_pieces_blocks_and_clashing_columns(spark, make_docs, monkeypatch):
    monkeypatch.setattr(op, "ENTRIES", 300)
    monkeypatch.setattr(families, "BLOCK", 4)
    monkeypatch.setattr(families, "BLOCK_BYTES", 2000)
    docs = fixture(3)
    table, _ = make_docs(docs)
    wide = table.withColumns({c: F.lit("x") for c in ("key", "cid", "asks", "payload", "set_key", "component_id")})
    null = lambda i: None if i == -2 ** 63 else i
    out = op.jaccard_components(wide, shingle=2)
    assert {null(r.doc_id): (r.n_shingles, null(r.component_id)) for r in out.collect()} == want(docs, 2)
    assert op.jaccard_components(table.limit(0)).count() == 0


def sets_near(r, size, drop, add):
    g = np.unique(r.integers(0, 2 ** 64, size, np.uint64))
    keep = np.sort(r.permutation(g)[:len(g) - drop])
    return g, np.unique(np.r_[keep, r.integers(0, 2 ** 64, add, np.uint64)])


def test_every_similar_pair_meets_whatever_the_costs():
    """Pigeonhole: the asked segments of the larger set answer for any partner."""
    r = np.random.default_rng(4)
    met = tried = 0
    for _ in range(1500):
        size = int(r.choice([5, 6, 9, 10, 17, 31, 32, 33, 39, 63, 64, 79, 200, 511, 512, 640]))
        room = op.may_differ(size, size, 80, 100)
        a, b = sets_near(r, size, int(r.integers(0, room + 1)), int(r.integers(0, room + 1)))
        big, small = (a, b) if len(a) >= len(b) else (b, a)
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 80 * (len(a) + len(b) - shared) or shared == len(a) == len(b):
            continue
        tried += 1
        keys, index, deep = op.entries(big, 80, 100)
        others = r.integers(0, 3, len(keys)) * r.integers(0, 100, len(keys))         # any costs
        mine, indexed, _ = op.entries(small, 80, 100)
        there = np.isin(keys, mine[indexed])
        others = np.maximum(others, there)                                            # the partner itself is counted
        met += there[op.allocate(len(big), deep, others, 80, 100)].any()
    assert tried > 300 and met == tried


def test_bitmap_never_rejects_a_similar_pair():
    r = np.random.default_rng(5)
    agree = op.agreeing(80, 100)
    pack = lambda g: np.frombuffer(op.bitmap(g), np.uint8)[None]
    for size in (5, 50, 500, 20_000):
        room = op.may_differ(size, size, 80, 100) // 2
        a, b = sets_near(r, size, room, room)
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 80 * (len(a) + len(b) - shared):
            assert agree(pack(a), pack(b))[0]
    a, b = sets_near(r, 500, 150, 150)
    assert not agree(pack(a), pack(b))[0]


def test_asked_lists_over_batches():
    r = random.Random(6)
    rows = sorted(((k, not a, c, a) for c, (k, a) in enumerate((r.randrange(40), r.random() < 0.2) for _ in range(120))))
    keep = {k for k in range(40) if any(a for q, _, _, a in rows if q == k) and sum(q == k for q, *_ in rows) > 1}
    for size in (1, 2, 7, 200):
        batches = [pa.RecordBatch.from_pydict({"key": [x[0] for x in p], "cid": [x[2] for x in p], "asks": [x[3] for x in p]})
                   for p in (rows[i:i + size] for i in range(0, len(rows), size))]
        out = [(k, c) for b in op.asked_lists(iter(batches)) for k, c in zip(*(b.column(i).to_pylist() for i in (0, 1)))]
        assert sorted(out) == sorted((k, c) for k, _, c, _ in rows if k in keep)


def test_near_misses_and_a_shared_passage(spark, make_docs):
    """Mutual near misses, and texts that share a passage of a third of their words, stay alone."""
    r = random.Random(7)
    passage = " ".join(f"p{k}" for k in range(60))
    docs = near_misses(300) + [(5000 + i, " ".join(f"v{r.randrange(10 ** 6)}" for _ in range(100)) + " " + passage) for i in range(300)]
    _, sf = make_docs(docs)
    assert got(op.query(spark, sf)) == want(docs)
    assert low(None) == -2 ** 63
