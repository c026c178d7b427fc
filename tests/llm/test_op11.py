import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from llm_helpers import by_id
from quarry.llm import op11_alignment as op

BYTE_OF = op.byte_characters()


@pytest.fixture(scope="module")
def libraries():
    t = tokenizers.Tokenizer.from_file(op.A_PATH)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=op.B_PATH)


def brute(rows, libraries):
    """The contract by the files' own libraries, token by token."""
    t, s = libraries
    docs = []
    for i, text in rows:
        if not text:
            docs.append((i, [], [], []))
            continue
        whole = (" " + text).encode()
        a = [(x, bytes(BYTE_OF[c] for c in t.id_to_token(x))) for x in t.encode(" " + text, add_special_tokens=False).ids]
        b = [(x, bytes([int(s.id_to_piece(x)[3:5], 16)]) if s.is_byte(x) else s.id_to_piece(x).replace("▁", " ").encode()) for x in s.encode(text)]
        if b"".join(y for _, y in a) != whole or b"".join(y for _, y in b) != whole:
            docs.append((i, [], [], []))
            continue
        groups, links, k, m, ga, gb = [], [], 0, 0, [], []
        end_a = end_b = 0
        while k < len(a) or m < len(b):
            if end_a <= end_b and k < len(a):
                ga.append(a[k][0])
                end_a += len(a[k][1])
                k += 1
            else:
                gb.append(b[m][0])
                end_b += len(b[m][1])
                m += 1
            if end_a == end_b:
                groups.append((ga, gb))
                links.append((ga[-1], gb[-1]))
                ga, gb = [], []
        docs.append((i, (len(a), len(b)), groups, links))
    count = Counter(p for d in docs for p in d[3])
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = {}
    for i, n, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[i] = (*(n or (0, 0)), len(groups), len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links),
                  hashlib.sha256(text.encode()).hexdigest() if groups else "")
    return out


def got(df):
    return {i: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for i, r in by_id(df).items()}


SPECIAL = ["", None, " ", "  two  spaces ", "tab\tand\nline\r\n", "<|endoftext|>", "a<s></s><unk>b", "mark ▁ inside", "▁", "\0nul\0", "é è 漢字 かな 🙂👩‍👩‍👧",
           "x" * 5000, "ab " * 4000, " " * 3000, "é ﬁ Ω K", "﻿bom", "'s 'll don't 123 4567,89"]


def texts():
    r = random.Random(4)
    chars = "abc deé漢🙂\n\t'1234.▂" + "".join(chr(r.randrange(0x20, 0xD7FF)) for _ in range(60))
    out = SPECIAL + ["".join(r.choice(chars) for _ in range(r.randint(1, 80))) for _ in range(120)]
    return [(i, t) for i, t in enumerate(out)] + [(None, "no id"), (500, "twice the same"), (500, "twice the same"), (501, "twice the same")]


def test_against_the_libraries(spark, make_docs, libraries):
    rows = texts()
    docs, sf = make_docs(rows)
    assert got(op.query(spark, sf)) == brute(rows, libraries)


def test_all_documents_of_the_small_table(spark, libraries):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op.query(spark, sf)) == brute(rows, libraries)


def test_clashing_columns_empty_table_and_long_text(spark, make_docs, libraries):
    rows = [(1, "some words " * 30_000), (2, "y" * 400_000), (3, "short")]
    docs, _ = make_docs(rows)
    wide = docs.withColumns({c: F.lit(1) for c in ("n_a", "links", "pair", "n", "groups_sha256")})
    assert got(op.align_documents(wide)) == brute(rows, libraries)
    assert op.align_documents(docs.limit(0)).count() == 0
