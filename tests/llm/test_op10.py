import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import families
from quarry.llm import op10_minhash as op
from quarry.llm.common import A_Z, PIECE_BYTES, SPACED, word_hashes
from quarry.llm.components import components

LOW = str.maketrans(A_Z, A_Z.lower())
WORD = re.compile(r"[^\x20\x09-\x0D]+")
low = lambda i: -2 ** 63 if i is None else i


def shingles(t, k):
    w = WORD.findall((t or "").translate(LOW))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, k=2):
    sets = [(low(i), shingles(t, k)) for i, t in docs]
    boss = {i: i for i, _ in sets}

    def find(i):
        while boss[i] != i:
            i = boss[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = sorted((find(i), find(j)))
                boss[q] = p
    null = lambda i: None if i == -2 ** 63 else i
    return {null(i): (len(s), null(find(i)), i == find(i)) for i, s in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def fixture(seed=1, n=120):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)] + ["the", "of"] * 60
    say = lambda k: [r.choice(vocab) for _ in range(k)]
    bases = [say(r.randint(8, 120)) for _ in range(8)]
    docs = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "two one"), (7, "the " * 500), (8, "the the")]
    for i in range(9, n):
        w = list(r.choice(bases)) if r.random() < 0.8 else say(r.randint(1, 60))
        for _ in range(r.randint(0, max(1, len(w) // 9))):
            w[r.randrange(len(w))] = r.choice(vocab)
        docs.append((i, r.choice([" ", "\n"]).join(w).title() if r.random() < 0.2 else " ".join(w)))
    return docs + [(300, docs[20][1]), (301, docs[20][1].upper()), (None, docs[21][1]), (302, docs[22][1]), (302, docs[22][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_brute_force(spark, make_docs, seed):
    docs = fixture(seed)
    _, sf = make_docs(docs)
    assert got(op.query(spark, sf)) == brute(docs)


def test_blocks_lots_and_clashing_columns(spark, make_docs, monkeypatch):
    """Small blocks: long lists and components are dealt out and still whole."""
    monkeypatch.setattr(families, "BLOCK", 4)
    monkeypatch.setattr(families, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(families, "QUERIES", 3)
    docs = fixture(3)
    table, _ = make_docs(docs)
    wide = table.withColumns({c: F.lit("x") for c in ("keys", "sketch", "cid", "set_key", "component_id", "_id")})
    out = op.near_duplicates(wide, shingle=2)
    want = brute(docs)
    assert {(r.doc_id if r.doc_id != -2 ** 63 else None): (r.component_id if r.component_id != -2 ** 63 else None) for r in out.collect()} == {i: w[1] for i, w in want.items()}
    kept = op.one_per_group(wide, shingle=2)
    assert kept.columns == wide.columns and {r.doc_id for r in kept.collect()} == {i for i, w in want.items() if w[2]}
    assert op.near_duplicates(table.limit(0)).count() == 0


def test_five_words_and_long_texts_in_pieces(spark, make_docs, monkeypatch):
    docs = fixture(4)
    table, _ = make_docs(docs)
    want = {low(i): (w[0], low(w[1])) for i, w in brute(docs, 5).items()}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op.near_duplicates(table).collect()} == want
    import pyarrow as pa
    texts = [t or "" for _, t in docs] + [" ".join(f"w{k % 977}" for k in range(400_000)), "a b c d e f"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    assert [len(g) for g in op.shingle_sets(batch, 5)] == [len(shingles(t, 5)) for t in texts]


def test_words_longer_than_a_piece():
    import pyarrow as pa
    huge, next_ = "x" * (PIECE_BYTES + 5), "y" * (2 * PIECE_BYTES)
    texts = [f"a b {huge} c d", f"{huge} a b c", f"a b c {huge}", f"{huge}\n", f"{huge} {next_} a {huge}\n", "a b c", "a\n"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    for k in (1, 2, 3, 5):
        want = [distinct_hashes(t, k) for t in texts]
        assert [g.tolist() for g in op.shingle_sets(batch, k)] == want
        assert [len(g) for g in want] == [len(shingles(t, k)) for t in texts]


def distinct_hashes(t, k):
    """Hashes of the shingles of all words at once."""
    data = np.frombuffer(t.encode(), np.uint8)
    h = word_hashes(data, np.array([0, len(data)]), SPACED, lower=True)[3]
    return np.unique(op.shingle_hashes(h, k)).tolist()


def test_signatures_estimate_similarity():
    r = np.random.default_rng(0)
    a = r.integers(0, 2 ** 63, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2400], r.integers(0, 2 ** 63, 0, dtype=np.uint64)])           # similarity 0.8
    (ka, sa), (kb, sb) = op.signature(np.sort(a)), op.signature(np.sort(b))
    assert (ka == kb).sum() >= op.MATCH and (sa == sb).sum() >= op.SKETCH_MATCH
    (kc, sc) = op.signature(r.integers(0, 2 ** 63, 3000, dtype=np.uint64))
    assert (ka == kc).sum() == 0 and (sa == sc).sum() < 20


def test_components(spark):
    r = random.Random(0)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    boss = {}
    find = lambda x: x if boss.setdefault(x, x) == x else find(boss[x])
    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            boss[q] = p
    got_ = {x.id: x.comp for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got_ == {x: find(x) for x in boss}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_misses(n, words=60, seed=3):
    """Texts that differ from one base in places of their own: mutual similarity about 0.7 on single words."""
    r = random.Random(seed)
    base = [f"b{k}" for k in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for k in r.sample(range(words), words // 10):
            w[k] = f"x{i}_{k}"
        out.append((i, " ".join(w)))
    return out


def test_near_misses_cost_links_in_proportion(spark, make_docs, monkeypatch):
    """A group of mutual near misses: what the steps write grows with the group, not with its square."""
    written = {}
    real = families.cut

    def counted(df, name):
        out = real(df, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(families, "cut", counted)
    rows = {}
    for n in (500, 5000):
        written.clear()
        docs = near_misses(n)
        table, _ = make_docs(docs)
        out = {r.doc_id: r.component_id for r in op.near_duplicates(table, shingle=1).collect()}
        rows[n] = dict(written)
        want = brute(docs, 1) if n == 500 else None
        assert want is None or out == {i: w[1] for i, w in want.items()}
    assert rows[5000]["family-members"] == 5000                  # one family
    for name, few in rows[500].items():
        assert rows[5000][name] <= 20 * max(few, 50), (name, rows)


def test_links_of_a_block_span_its_families():
    agree = lambda a, b: (a == b).all(1)
    r = np.random.default_rng(2)
    n = 400
    x = {"g": np.stack([np.sort(r.integers(0, 5, n)), np.zeros(n, np.int64)], 1), "role": np.zeros(n, np.int32),
         "family": r.integers(0, 60, n), "payload": r.integers(0, 4, (n, 1)).astype(np.uint8)}
    family, g = x["family"].copy(), x["g"][:, 0]
    a, b = families.link_blocks(x, 0, agree, False)
    for block in range(5):
        boss = {}
        find = lambda v: v if boss.setdefault(v, v) == v else find(boss[v])
        mine = np.flatnonzero(g == block)
        for i in mine:
            for j in mine:
                if x["payload"][i, 0] == x["payload"][j, 0]:
                    p, q = sorted((find(family[i]), find(family[j])))
                    boss[q] = p
        roots = {v: {w for w in family[mine] if find(w) == find(v)} for v in family[mine]}
        after = {v: set(family[mine][x["family"][mine] == x["family"][i]]) for i, v in zip(mine, family[mine])}
        assert roots == after
    assert len(a) <= sum(len(set(family[g == k])) - 1 for k in range(5))
