import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import op13_prefix_trie as op

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, family=20, heads=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, key, role, text))
    own = {c: [(x[3], x[4]) for x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        full[c] = own.get(base, [])[:h] + v[h:]
    nodes = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            nodes[tuple(full[c][:d])].append(c)
    value = {k: (len(v) - 1) * (len(WORD.findall(k[-1][1])) if k else 0) for k, v in nodes.items()}
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    for k in nodes:
        for d in range(len(k) + 1):
            saved[k[:d]] += value[k]
            leaves[k[:d]] += not children[k]
    out = []
    for k, v in nodes.items():
        ends = ",".join(str(c) for c in v if len(full[c]) == len(k))
        out.append((v[0], len(k), nodes[k[:-1]][0] if k else None, len(v), children[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def fixture(seed, n=70):
    r = random.Random(seed)
    say = lambda: " ".join(r.choice("ab cd ef gh é".split()) for _ in range(r.randint(0, 4)))
    starts = [[(r.choice(["user", "system"]), say()) for _ in range(r.randint(1, 6))] for _ in range(6)]
    rows = []
    for c in [*range(n), -3, -20, 10 ** 14, 10 ** 14 + 3]:
        if r.random() < 0.1 and c % 20 == 0:
            continue                                           # a family without its first conversation
        turns = list(r.choice(starts)) + [(r.choice(["user", None]), r.choice([say(), None])) for _ in range(r.randint(0, 5))]
        turns = turns[:r.randint(1, len(turns))]
        rows += [(c, None if i == 0 and r.random() < 0.2 else i, role, text) for i, (role, text) in enumerate(turns)]
    rows += [(5, 1, "user", "twice"), (5, 1, "user", "twice"), (5, 1, "tool", "again"), (None, 0, "user", "no conversation")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_brute_force(spark, make_docs, seed):
    rows = fixture(seed)
    _, sf = make_docs([], conversations=(rows, SCHEMA))
    assert got(op.query(spark, sf)) == brute(rows)


def test_long_conversations_cross_partitions_and_stretches(spark, monkeypatch):
    """One conversation holds a third of the rows; others copy it up to some turn."""
    monkeypatch.setattr(op, "SEGMENT", 3)
    monkeypatch.setattr(op, "SHARD_ROWS", 40)
    r = random.Random(5)
    long = [(1, i, "user", f"turn {i % 7} words") for i in range(150)]
    rows = long + [(2, i, role, t) for _, i, role, t in long[:100]] + [(7, i, role, t) for _, i, role, t in long[:149]]
    rows += [(c, i, "user", f"turn {i % 7} words" if r.random() < 0.9 else "else") for c in range(30, 60) for i in range(r.randint(1, 12))]
    rows += [(40, 99 + i, "user", "tail") for i in range(9)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(op.prefix_trie(table)) == brute(rows)
    assert got(op.prefix_trie(table, heads=1)) == brute(rows, heads=1)


def test_empty_and_clashing_columns(spark):
    rows = fixture(3, 30)
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("d", "x1", "p1", "words", "ghost", "shard", "digest", "part")})
    assert got(op.prefix_trie(table)) == brute(rows)
    assert op.prefix_trie(table.limit(0)).count() == 0


def test_hot_end_is_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK", 64)
    rows = [(c, 0, "user", "same") for c in range(900)] + [(2000, 0, "user", "same"), (2000, 1, "user", "")]
    assert got(op.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_node_table_is_minimal_perfect_and_verified():
    r = np.random.default_rng(1)
    x, y, d = r.integers(0, 2 ** 64, 5000, np.uint64), r.integers(0, 3, 5000).astype(np.uint64), r.integers(0, 9, 5000)
    nodes = op.NodeTable(x, y, d)
    assert sorted(nodes.slots(x, y, d)) == list(range(5000))
    assert (nodes.slots(x, y + np.uint64(9), d) == -1).all() and (nodes.slots(x, y, d + 100) == -1).all()
    assert len(op.NodeTable(x[:0], y[:0], d[:0])) == 0
