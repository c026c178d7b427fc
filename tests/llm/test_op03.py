import itertools
import math
import random

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

from llm_helpers import by_id
from quarry.llm import op03_sentencepiece as op

LIB = sentencepiece.SentencePieceProcessor(model_file=op.MODEL_PATH)
MODEL = op.Model(open(op.MODEL_PATH, "rb").read())
HARD = ["", " ", "   ", "a", " a", "a  b   c ", "Hello  World\n été 😀\t x ", "x" * 5000, "ab" * 3000, "\x00\x01", "日本語テキスト", "🇫🇷",
        "aaaa" * 100 + " " * 100 + "b", "==== ---- ////", "https://example.com/a?b=c&d=%20", "é", " nbsp　wide", "0123456789" * 9]


def test_same_ids_as_the_library():
    r = random.Random(5)
    letters = "abcdefgt  he.,()\n0189éß_-=日▁😀"
    texts = HARD + ["".join(r.choice(letters) for _ in range(r.randint(1, 80))) for _ in range(3000)]
    texts += [t for t, in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' order by doc_id limit 400").fetchall()]
    for t in texts:
        assert MODEL.encode(t).tolist() == LIB.encode(t), t
        if op.MARK not in t:
            assert MODEL.decode(MODEL.encode(t)) == t


def test_query(make_docs, spark):
    rows = list(enumerate(HARD)) + [(100, None), (None, "null id"), (3, HARD[3])]
    docs, sf = make_docs(rows)
    got = op.query(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        t = ("null id" if r.doc_id is None else dict(rows)[r.doc_id]) or ""
        assert r.ids == LIB.encode(t) and r.n_tokens == len(r.ids) and r.round_trip
    wide = docs.withColumns({c: F.lit(1) for c in ("ids", "round_trip")})
    back = by_id(op.decode_docs(op.encode_docs(wide)))
    assert all(back[i].text == t for i, t in enumerate(HARD))
    assert op.encode_docs(docs.limit(0)).count() == 0


def test_unigram_shortest_path_against_all_paths():
    r = random.Random(2)
    pieces = [("<unk>", 0.0, op.UNKNOWN)] + [(f"<0x{b:02X}>", 0.0, op.BYTE) for b in range(256)]
    for p in ["a", "b", "c", "ab", "bc", "abc", "ca", op.MARK, op.MARK + "a", op.MARK + "ab"]:
        pieces.append((p, -r.random() * 9 - 1, op.NORMAL))
    m = op.Model.of(pieces)
    cost = {p: -s for p, s, t in pieces if t == op.NORMAL}
    for _ in range(200):
        s = op.MARK + "".join(r.choice("abc") for _ in range(r.randint(1, 7)))
        best = math.inf
        for cuts in itertools.product([0, 1], repeat=len(s) - 1):
            at = [0] + [i + 1 for i, c in enumerate(cuts) if c] + [len(s)]
            best = min(best, sum(cost.get(s[a:b], math.inf) for a, b in zip(at, at[1:])))
        got = sum(m.weight[i] for i in m.path(s))
        assert math.isclose(got, best)
    assert m.decode(m.encode("ab é")) == "ab é"


def test_refused_models():
    with pytest.raises(ValueError, match="user-defined"):
        op.Model.of([("x", 0.0, op.USER)])
