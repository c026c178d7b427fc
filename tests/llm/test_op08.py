import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import common, op08_decontaminate as op
from quarry.llm.common import A_Z

LOWER = str.maketrans(A_Z, A_Z.lower())
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
words = lambda t: WORD.findall((t or "").translate(LOWER))


def brute(docs, items, window=13):
    out = {}
    for i, t in docs:
        w, hit, seen = words(t), set(), set()
        for item, u in items:
            v = words(u)
            for a in range(max(1, len(v) - window + 1) if v else 0):
                p = v[a:a + window]
                for b in range(len(w) - len(p) + 1):
                    if w[b:b + len(p)] == p:
                        hit |= set(range(b, b + len(p)))
                        seen.add("" if item is None else str(item))
        out[i] = (len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(),
                  0 < len(hit) and 20 * len(hit) >= len(w))
    return out


def got(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def fixture(seed=3):
    r = random.Random(seed)
    vocab = ["the", "of", "a", "Été", "x1", "ß", "non", "que", "zz", "q"]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(k, say(r.randint(13, 40))) for k in range(12)] + [(12, "short item zz"), (13, ""), (14, None), (None, say(14)), (0, say(20))]
    docs = [(0, None), (1, ""), (2, "..."), (3, items[0][1]), (4, items[1][1].upper() + "!"), (5, "zz short-item, ZZ short item zz short item zz"),
            (6, " ".join("the" for _ in range(500)))]
    for k in range(7, 60):
        part = words(r.choice(items)[1])
        a = r.randint(0, max(0, len(part) - 12))
        docs.append((k, f"{say(r.randint(0, 300))} {', '.join(part[a:])}. {say(r.randint(0, 30))}"))
    return docs + [(100, "the " * 40), (100, "the " * 40)], items


def test_query_against_brute_force(make_docs, spark):
    docs, items = fixture()
    _, sf = make_docs(docs, benchmark=(items, "item_id long, text string"))
    assert got(op.query(spark, sf)) == brute(docs, items)


def test_small_pieces_and_blocks(make_docs, spark, monkeypatch):
    """Documents longer than a piece, and a benchmark of several blocks."""
    docs, items = fixture(4)
    table, _ = make_docs(docs[:100])
    bench = spark.createDataFrame(items, "item_id long, text string")
    wide = table.withColumns({c: F.lit("x") for c in ("starts", "ends", "items", "text_key", "n_words")})
    assert got(op.report(op.find_spans(wide, bench, block_bytes=300))) == brute(docs, items)
    n = 0
    for t in [d[1] or "" for d in docs]:
        raw = np.frombuffer(t.encode(), np.uint8)
        got_words = {}
        for _, d, _, s, e, _, first, _ in common.word_pieces(raw, np.array([0, len(raw)]), common.ALNUM, 12, most=64):
            for j, (a, b) in enumerate(zip(s, e)):
                w = common.LOWER[d[a:b]].tobytes().decode()
                assert got_words.setdefault(first + j, w) == w
                n += 1
        assert [got_words[j] for j in sorted(got_words)] == words(t)
    assert n


def test_pieces_hold_every_window():
    """Words longer than a piece do not cost a window."""
    for t in ("a b HHHHHHHH c d", "HHHHHHHH a b c", "a b HHHHHHHH", "HHHHHHHH\n", "HHHHHHHH IIIIIIIIII a JJJJJJJJ\n"):
        raw, w = np.frombuffer(t.encode(), np.uint8), t.split()
        for k in (1, 2, 3, 5):
            seen = set()
            for _, d, _, s, e, _, first, _ in common.word_pieces(raw, np.array([0, len(raw)]), common.ALNUM, k - 1, most=4):
                piece = [d[a:b].tobytes().decode() for a, b in zip(s, e)]
                assert piece == w[first:first + len(piece)]
                seen |= {first + j for j in range(len(piece) - k + 1)}
            assert seen == set(range(len(w) - k + 1))


def test_fm_index_counts_and_positions():
    r = random.Random(1)
    for _ in range(40):
        s = np.array([0] + [r.choice([0, 1, 1, 2, 3, 4, 4]) for _ in range(r.randint(1, 200))] + [0])
        sa = op.suffix_array(s, 3)
        key = lambda i: [(0, j) if s[j] == 0 else (1, s[j]) for j in range(i, len(s))]
        assert list(sa) == sorted(range(len(s)), key=key)
        index = op.FMIndex(s, 4)
        assert sorted(index.locate(np.flatnonzero(s[sa] > 0)).tolist()) == [i for i in range(len(s)) if s[i] > 0]


def test_empty_tables(make_docs, spark):
    table, sf = make_docs([(1, "a b")], benchmark=([], "item_id long, text string"))
    assert got(op.query(spark, sf))[1][:2] == (2, 0)
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert op.find_spans(table.limit(0), bench).count() == 0


def test_clean_rows_keep_columns(make_docs, spark):
    docs, items = fixture()
    table, _ = make_docs(docs)
    wide = table.withColumn("_hit", F.lit(1))
    out = op.clean_rows(wide, spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert out.columns == wide.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, _ in docs if not want[i][4])
