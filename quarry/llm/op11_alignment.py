"""Alignment of two tokenizers' tokens over whole texts.

Both tokenizers spell the same bytes (a space and the text), so each gives a
list of cumulative byte ends. A dictionary from end to index for either list,
the intersection of their keys as hash sets, and the sorted common ends, which
slice both id lists into groups. The last tokens of a group end together and
are linked; every slice has one such link.

Stretches: no token of either vocabulary reaches over a single blank between
two characters that are no white space (the split pattern begins a token at
such a blank; no piece has the word mark after another character, which is
checked). So a text falls into stretches there, each of which is encoded and
aligned by itself, and what frequent stretches give is kept in a table of
bounded size.

Corpus-wide counts of linked id pairs take a second look at the links:

1. texts are encoded, aligned and written once, with their links in the row
   (place in the pair universe, two or three bytes each after compression);
2. the links are counted by pair with one partial sum per task;
3. counts go back to the links, which are summed per text.

Pair universe: two tokens that end together are such that one's bytes end the
other's, so the pairs that can ever be linked are listed from the two
vocabularies alone: 324,300 for the given files. Counting table and broadcast
are bounded by it whatever the input.

The byte-level vocabulary is read from its own file. Its merges stand in id
order (this is checked), so its ids are ranks for the rank-based encoder,
which gives the same ids several times faster; the file's special tokens are
left out, so their strings are ordinary text. Files are broadcast (2 MB).

Defined cases: null and empty texts, and texts whose tokens spell other bytes
(such as one that holds the word mark U+2581, which decodes to a space), have
no tokens: zeros and ''. Repeated rows are aligned each, and their links
count each time. A null id stays null. An empty table gives an empty result.
Extra columns are ignored. A text is encoded whole in its task, however long.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, key_text, restore_id

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# The split pattern of the byte-level vocabulary's encoder, and
# the bytes that it writes as the character of the same number.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BORDER = re.compile(r" (?=\S)(?<=\S )")
COMMA, BAR, SEMI, NONE = 0, 1, 2, 3
SEPARATORS = np.frombuffer(b",|;\0", np.uint8)
KEPT = 200_000                   # stretches whose alignment is kept
KEPT_CHARS = 48                  # longer ones are not kept


def byte_characters() -> dict[str, int]:
    """Character -> byte of the byte-level spelling: other bytes follow from 256 on."""
    rest = [b for b in range(256) if b not in PRINTED]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """The byte-level vocabulary of a tokenizer file."""

    def __init__(self, data: bytes):
        model = json.loads(data)["model"]
        spell, vocab = byte_characters(), model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(merges)) or len(vocab) != 256 + len(merges):
            raise ValueError("the vocabulary's ids are not in merge order")
        ranks = {bytes(spell[c] for c in t): i for t, i in vocab.items()}
        self.encoder = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.spelled = [b""] * len(ranks)
        for t, i in ranks.items():
            self.spelled[i] = t

    def encode(self, texts: list[str]) -> list[list[int]]:
        return list(map(self.encoder.encode_ordinary, texts))


class Pieces:
    """The vocabulary of a SentencePiece model."""

    def __init__(self, data: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        piece = lambda i: self.model.id_to_piece(i)
        self.spelled = [bytes([int(piece(i)[3:5], 16)]) if self.model.is_byte(i) else piece(i).replace(MARK, " ").encode()
                        for i in range(self.model.get_piece_size())]

        if any(" " in t.lstrip(b" ").decode("latin-1") for t in self.spelled):
            raise ValueError("a piece reaches over a blank")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def cells(size: int) -> np.ndarray:
    """Decimal digits of every id, right-aligned, with room for a separator; 0 where nothing stands."""
    width = len(str(size - 1))
    out = np.zeros((size, width + 1), np.uint8)
    for i in range(size):
        s = str(i).encode()
        out[i, width - len(s):width] = np.frombuffer(s, np.uint8)
    return out


Aligned = tuple[int, int, int, bytes, bytes]      # A and B tokens, groups, spelled groups, links as places of 4 bytes


class Aligner:
    """Both vocabularies, and the pairs that can end together."""

    def __init__(self, a_file: bytes, b_file: bytes):
        self.a, self.b = ByteLevel(a_file), Pieces(b_file)
        self.a_len, self.b_len = (np.array([len(t) for t in v.spelled], np.int64) for v in (self.a, self.b))
        self.cells = cells(max(len(self.a.spelled), len(self.b.spelled)))
        self.kept: dict[str, Aligned | None] = {}
        a_ids, b_ids = ({} for _ in range(2))
        for ids, v in ((a_ids, self.a), (b_ids, self.b)):
            for i, t in enumerate(v.spelled):
                ids.setdefault(t, []).append(i)
        pairs = set()
        for mine, other, flip in ((a_ids, b_ids, False), (b_ids, a_ids, True)):
            for t, ids in mine.items():
                for k in range(len(t)):
                    for j in other.get(t[k:], ()):
                        pairs.update((j, i) if flip else (i, j) for i in ids)
        self.pairs = np.array(sorted(a << 32 | b for a, b in pairs), np.int64)


    def stretches(self, texts: list[str]) -> dict[str, Aligned | None]:
        """The groups of different stretches; None where the two do not spell
        a space and the stretch. All stand one after the other on one line of
        bytes, on which every stretch's end is a common end."""
        out: dict[str, Aligned | None] = dict.fromkeys(texts)
        good, a, b = [], [], []
        for text, x, y in zip(texts, self.a.encode([" " + t for t in texts]), self.b.encode(texts)):
            if b"".join(map(self.a.spelled.__getitem__, x)) == b"".join(map(self.b.spelled.__getitem__, y)) == (" " + text).encode():
                good.append(text)
                a.append(x)
                b.append(y)
        if not good:
            return out
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(good)) for x in (a, b))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a, n_a), (b, n_b)))
        at_a = dict(zip(np.cumsum(self.a_len[a]).tolist(), range(1, len(a) + 1)))
        at_b = dict(zip(np.cumsum(self.b_len[b]).tolist(), range(1, len(b) + 1)))
        common = sorted(at_a.keys() & at_b.keys())
        cut_a = np.fromiter(map(at_a.__getitem__, common), np.int64, len(common))
        cut_b = np.fromiter(map(at_b.__getitem__, common), np.int64, len(common))
        links = np.searchsorted(self.pairs, a[cut_a - 1] << 32 | b[cut_b - 1]).astype("<u4").tobytes()
        last = np.searchsorted(cut_a, np.cumsum(n_a))                 # each stretch's last group
        spelled, width = self.spelling(a, b, cut_a, cut_b, last)
        ends = np.cumsum(np.add.reduceat(width, np.cumsum(n_a + n_b) - (n_a + n_b)))
        lo = at = 0
        for text, x, y, g, end in zip(good, n_a.tolist(), n_b.tolist(), (last + 1).tolist(), ends.tolist()):
            out[text] = (x, y, g - at, spelled[lo:end], links[4 * at:4 * g])
            lo, at = end, g
        return out

    def spelling(self, a, b, cut_a, cut_b, last) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of every stretch, one after the other, and the
        bytes of each token with what follows it. ``last``: the groups that end a stretch."""
        n = len(a) + len(b)
        ids, after = np.empty(n, np.int64), np.full(n, COMMA)
        # a group's A ids stand after the B ids of the groups before it, its B ids after its A ids
        size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        at_a = np.arange(len(a)) + np.repeat(cut_b - size_b, size_a)
        at_b = np.arange(len(b)) + np.repeat(cut_a, size_b)
        ids[at_a], ids[at_b] = a, b
        after[at_a[cut_a - 1]], after[at_b[cut_b - 1]] = BAR, SEMI
        after[at_b[cut_b[last] - 1]] = NONE
        text = self.cells[ids]
        text[:, -1] = SEPARATORS[after]
        there = text != 0
        return text[there].tobytes(), there.sum(1)

    def align(self, texts: list[str]) -> Iterator[Aligned | None]:
        """Tokens, groups and links of whole texts; None: no tokens."""
        parts = [BORDER.split(t) if t else None for t in texts]
        if len(self.kept) > KEPT:
            self.kept.clear()
        new = list({w for p in parts if p for w in p if w not in self.kept})
        found = self.stretches(new) if new else {}
        self.kept.update((w, x) for w, x in found.items() if len(w) <= KEPT_CHARS)
        for p in parts:
            all_ = [found[w] if w in found else self.kept[w] for w in p or ()]
            if not all_ or None in all_:
                yield None
                continue
            n_a, n_b, n, spelled, links = zip(*all_)
            yield sum(n_a), sum(n_b), sum(n), b";".join(spelled), b"".join(links)


@functools.lru_cache(maxsize=2)
def aligner(a_file: bytes, b_file: bytes) -> Aligner:
    """One per Python worker and pair of files."""
    return Aligner(a_file, b_file)


def planes(numbers: bytes) -> bytes:
    """Four-byte numbers byte by byte."""
    return np.ascontiguousarray(np.frombuffer(numbers, np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel()


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
ROWS = 128                       # texts whose ids and links are held at once


def aligned_texts(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """Per document its numbers of tokens and groups, the groups' digest and its links."""
    keyed = key_text(docs)
    files = tuple(open(p, "rb").read() for p in (a_path, b_path))
    shared = keyed.sparkSession.sparkContext.broadcast(files)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(*shared.value)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in chain.from_iterable((b.slice(k, ROWS) for k in range(0, b.num_rows, ROWS)) for b in batches):
            rows = [(0, 0, 0, "", b"") if x is None else (*x[:3], hashlib.sha256(x[3]).hexdigest(), squeeze(planes(x[4])))
                    for x in al.align(b.column("text").to_pylist())]
            n_a, n_b, groups, sha, links = zip(*rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n_a, n_b, groups)),
                                              pa.array(sha, pa.string()), pa.array(links, pa.binary())],
                                             names=[x.split()[0] for x in ALIGNED.split(", ")])

    return keyed.mapInArrow(task, ALIGNED)


def link_lists(column) -> Iterator[np.ndarray]:
    expand = zstandard.ZstdDecompressor().decompress
    for blob in column:
        blob = blob.as_py()
        yield from_planes(expand(blob)) if blob else np.zeros(0, np.uint32)


def pair_counts(aligned: DataFrame, size: int) -> np.ndarray:
    """Links per pair of the universe, corpus-wide; the result has ``size`` entries."""
    def task(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for links in link_lists(b.column("links")):
                np.add.at(total, links, 1) if len(links) < 4096 else np.add(total, np.bincount(links, minlength=size), out=total)
        at = np.flatnonzero(total)
        for k in range(0, len(at), 50_000):
            part = at[k:k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["pair", "n"])

    counts = aligned.select("links").mapInArrow(task, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[counts.column("pair").to_numpy()] = counts.column("n").to_numpy()
    return out


SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align_documents(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    aligned = cut(aligned_texts(docs, a_path, b_path), "aligned")
    pairs = aligner(*(open(p, "rb").read() for p in (a_path, b_path))).pairs
    count = pair_counts(aligned, len(pairs))
    b_id = (pairs & 0xFFFFFFFF).astype(np.int64)
    top = np.zeros(int(b_id.max(initial=0)) + 1, np.int64)
    np.maximum.at(top, b_id, count)
    shared = docs.sparkSession.sparkContext.broadcast((count, count == top[b_id]))

    def task(batches):
        n, best = shared.value
        for b in batches:
            sums = [(len(x), int(best[x].sum()), int(n[x].sum())) for x in link_lists(b.column("links"))]
            cols = list(zip(*sums)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")),
                                              *(pa.array(c, pa.int64()) for c in cols), b.column("groups_sha256")],
                                             names=[x.split()[0] for x in SCORED.split(", ")])

    return aligned.mapInArrow(task, SCORED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(restore_id(), *out.columns[1:])


SQL = None      # the tokenizers cannot be said in SQL; tests/llm compares with a plain alignment by the files' own libraries
