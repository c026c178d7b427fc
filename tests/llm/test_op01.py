import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import op01_suffix_array as op


def brute(docs, w):
    low = lambda i: -2 ** 63 if i is None else i
    first, raw = {}, [(i, (t or "").encode()) for i, t in docs]
    for i, t in raw:
        for p in range(len(t) - w + 1):
            s = t[p:p + w]
            first[s] = min(first.get(s, (low(i), p)), (low(i), p))
    out = {}
    for i, t in raw:
        gone = set()
        for p in range(len(t) - w + 1):
            if first[t[p:p + w]] < (low(i), p):
                gone |= set(range(p, p + w))
        spans = sum(p not in gone or p - 1 not in gone for p in gone)
        out[i] = (len(t), len(gone), spans, hashlib.sha256(bytes(b for p, b in enumerate(t) if p not in gone)).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def fixture(seed=1):
    r = random.Random(seed)
    say = lambda k: "".join(r.choice("ab é\n😀c") for _ in range(k))
    shared = [say(r.randint(40, 400)) for _ in range(5)]
    docs = [(0, None), (1, ""), (2, "short"), (3, "a" * 3000), (4, "abc" * 700), (5, "x" + "a" * 150)]
    for i in range(6, 50):
        docs.append((i, say(r.randint(0, 200)) + r.choice(shared) + say(r.randint(0, 40)) + r.choice(shared)[r.randint(0, 60):]))
    docs += [(60, docs[8][1]), (61, docs[8][1]), (None, docs[9][1]), (62, docs[10][1]), (62, docs[10][1]), (63, (shared[0] + "\n") * 5)]
    return docs


def test_query_against_brute_force(spark, make_docs):
    docs = fixture()
    _, sf = make_docs(docs)
    assert got(op.query(spark, sf)) == brute(docs, 100)


@pytest.mark.parametrize("window, gram", [(30, 8), (9, 24)])
def test_other_windows_and_buckets(spark, make_docs, window, gram):
    docs = fixture(2)
    table, _ = make_docs(docs)
    wide = table.withColumns({c: F.lit(1) for c in ("starts", "ends", "bucket", "kept", "data")})
    spans = op.repeated_spans(wide, window, gram, bucket_bytes=500)
    out = op.remove_spans(wide, spans).withColumn("kept_sha256", F.sha2("kept", 256))
    assert got(out) == brute(docs, window)
    assert op.repeated_spans(table.limit(0)).count() == 0


def test_long_rows_come_in_overlapping_pieces():
    raw = np.frombuffer(bytes(range(250)) * 4, np.uint8)
    seen = set()
    for _, d, o, first in op.byte_pieces(raw, np.array([0, len(raw)]), 9, most=64):
        for p in range(len(d) - 9):
            assert d[p:p + 10].tobytes() == raw[first + p:first + p + 10].tobytes()
            assert first + p not in seen
            seen.add(first + p)
    assert seen == set(range(len(raw) - 9))


def test_deep_shallow_sort():
    r = random.Random(0)
    for _ in range(200):
        w, shallow = r.choice([5, 20, 33, 100]), r.choice([0, 8, 16, 24])
        t = bytes(r.choice(b"ab") for _ in range(r.randint(100, 400)))
        t = np.frombuffer(t + t[5:60] * r.randint(0, 4) + t[:150], np.uint8)
        sa, leaf = op.sort_suffixes(t, np.arange(len(t) - w + 1), w, shallow)
        keys = [t.tobytes()[p:p + w] for p in sa]
        assert keys == sorted(keys)
        assert len({*zip(keys, leaf.tolist())}) == len(set(keys)) == len(set(leaf.tolist()))
