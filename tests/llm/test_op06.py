import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm import common, op06_substring as op, superkmer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, k=13):
    low = lambda i: -2 ** 63 if i is None else i
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in split:
        for a in range(len(w) - k + 1):
            s = tuple(w[a:a + k])
            first[s] = min(first.get(s, low(i)), low(i))
    out = {}
    for i, w in split:
        gone = set()
        for a in range(len(w) - k + 1):
            if first[tuple(w[a:a + k])] < low(i):
                gone |= set(range(a, a + k))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def fixture(seed=1, n=60):
    r = random.Random(seed)
    vocab = ["the", "of", "Of", "été", "x", "a b", "😀", "longer-word"]
    say = lambda k: [r.choice(vocab) for _ in range(k)]
    shared = [say(r.randint(13, 70)) for _ in range(6)]
    docs = [(0, None), (1, ""), (2, " \t\n"), (3, "one two three"), (4, " ".join(["same"] * 400)), (5, "\n".join(["same"] * 90))]
    for i in range(6, n):
        parts = [say(r.randint(0, 40)), r.choice(shared), say(r.randint(0, 9)), r.choice(shared)[r.randint(0, 20):]]
        docs.append((i, r.choice([" ", "\n", "  "]).join(w for p in parts for w in p)))
    docs += [(100, docs[10][1]), (101, docs[10][1]), (None, docs[12][1]), (102, docs[11][1]), (102, docs[11][1])]
    return docs


def test_query_against_brute_force(spark, make_docs):
    docs = fixture()
    _, sf = make_docs(docs)
    assert got(op.query(spark, sf)) == brute(docs)


def test_small_pieces_runs_and_buckets(spark, make_docs, monkeypatch):
    docs = fixture(2)
    table, _ = make_docs(docs)
    wide = table.withColumns({c: F.lit(1) for c in ("starts", "ends", "bucket", "kept", "data")})
    spans = op.repeated_spans(wide, bucket_bytes=200)
    out = op.remove_spans(wide, spans).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    assert got(out) == brute(docs)
    assert op.repeated_spans(table.limit(0)).count() == 0


def test_words_longer_than_a_piece(spark, make_docs):
    say = lambda c, k: [f"{c}{j}" for j in range(k)]
    huge = "x" * (common.PIECE_BYTES + 5)
    shared = [say("s", 6) + [huge] + say("t", 6), [huge] + say("u", 12), say("v", 12) + [huge], say("w", 5) + [huge, huge] + say("z", 6)]
    docs = [(i, " ".join(say(f"a{i}", 3) + w + say(f"b{i}", 20)) + "\n") for i, w in enumerate(shared + shared)]
    _, sf = make_docs(docs + [(50, huge + "\n"), (51, " ".join([huge] * 13) + "\n"), (52, " ".join([huge] * 14))])
    want = brute(docs + [(50, huge), (51, " ".join([huge] * 13)), (52, " ".join([huge] * 14))])
    assert [want[i][1] for i in range(4, 8)] == [13] * 4 and want[52][1] == 14
    assert got(op.query(spark, sf)) == want


def test_bundles_cover_what_repeats_inside_a_task():
    raw = np.frombuffer(b"aabbaabb", np.uint8)
    arr = lambda *x: np.array(x, np.int64)
    lo, hi = arr(0, 4, 2, 0), arr(2, 6, 4, 2)
    for within, cover, starts in ((False, [5, 0, 2], [10, 30, 4]), (True, [5, 3, 0, 30, 2, 32], [10, 4])):
        b = superkmer.Bundles(1, within)
        b.add(raw, lo, hi, np.array([1, 1, 1, 1], np.uint64), np.array([7, 7, 9, 7], np.uint64), arr(5, 3, 5, 3), arr(0, 10, 4, 30), arr(2, 2, 2, 2))
        u = superkmer.Unpacked(pa.Table.from_batches([b.flush()]))
        doc, s, e = u.cover
        want = sorted(zip(cover[0:len(cover) // 3], cover[len(cover) // 3:2 * len(cover) // 3], cover[2 * len(cover) // 3:]))
        assert sorted(zip(doc.tolist(), s.tolist(), e.tolist())) == want
        assert u.starts.tolist() == starts and b.flush() is None


def test_equal_hashes_are_confirmed_on_bytes():
    data = np.frombuffer(b"abcabdabc", np.uint8)
    lo, hi = np.array([0, 3, 6]), np.array([3, 6, 9])
    cls = superkmer.same_strings(data, lo, hi, np.zeros(3, np.uint64))
    assert cls[0] == cls[2] >= 0 and cls[1] == -1


def test_long_runs_of_one_minimiser_are_cut():
    a, b = superkmer.window_runs(np.zeros(5000, np.uint64), np.ones(5000, bool))
    assert (b - a).max() <= superkmer.MAX_RUN and (b - a).sum() == 5000 and (a[1:] == b[:-1]).all()


def test_helpers():
    h = np.random.default_rng(0).integers(0, 99, 200).astype(np.uint64)
    for w in (1, 2, 5, 11, 85):
        assert (common.sliding_min(h, w) == [h[i:i + w].min() for i in range(len(h) - w + 1)]).all()
    k, s, e = common.merge_spans(np.array([1, 1, 0, 1]), np.array([5, 0, 2, 3]), np.array([9, 3, 4, 6]))
    assert (k.tolist(), s.tolist(), e.tolist()) == ([0, 1], [2, 0], [4, 9])
