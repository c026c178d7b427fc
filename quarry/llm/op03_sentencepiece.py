"""SentencePiece encoding and decoding as a weighted transducer.

The model file is compiled once per Python worker:

* normaliser: a transducer that maps spaces to the word mark and puts one
  mark in front of a text that is not empty, as the model's flags say;
* pieces: a prefix table whose states are piece prefixes and whose final
  states emit the piece;
* byte fallback: a character that no piece covers is spelled by byte pieces.

Composed with an input this gives a lattice of pieces, whose shortest path in
the tropical semiring (weights add along a path, the least path wins) is the
encoding. For a unigram model an arc weighs minus the piece's score. For a
merge (BPE) model an arc weighs 1, and weighs infinity after a piece it
cannot stand next to: two pieces may be neighbours exactly when merging their
joint string would end in these two. A sequence of pieces is the model's own
encoding if and only if all neighbours may stand together, so just one path
of finite weight remains, and every prefix has one as well: finding it is
finding the shortest path.

No piece of such models has the word mark after another character (this is
checked when compiling), so a text falls into independent stretches before
each run of marks; their encodings are cached in a table of bounded size. A
model without that property is handled as one stretch.

Every text is encoded whole in its task; nothing is shuffled; the model
(under 1 MB) is broadcast.

Defined cases: null and empty texts have no tokens and decode to ''. A text
that holds the word mark itself decodes to a space there, so it does not
round-trip. Repeated rows are encoded each; a null id stays null. Empty
tables give an empty result. Extra columns are ignored. Models with a
precompiled character map or user-defined pieces are refused by name.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_text, restore_id

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6    # piece types of the file format
UNIGRAM, BPE = 1, 2
CACHE = 300_000
INF = math.inf


def messages(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a serialised protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 0x7F) << shift
            if b < 0x80:
                return n
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at:at + n]
            at += n


class Model:
    """A compiled SentencePiece model."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        kind, self.dummy, self.squeeze = UNIGRAM, True, True
        for field, v in messages(data):
            if field == 1:
                p = dict(messages(v))
                self.pieces.append((p[1].decode(), struct.unpack("<f", p[2])[0] if 2 in p else 0.0, p.get(3, NORMAL)))
            elif field == 2:
                kind = dict(messages(v)).get(3, UNIGRAM)
            elif field == 3:
                n = dict(messages(v))
                if n.get(2):
                    raise ValueError("models with a precompiled character map are not supported")
                self.dummy, self.squeeze = bool(n.get(3, 1)), bool(n.get(4, 1))
                if not n.get(5, 1):
                    raise ValueError("models that keep spaces are not supported")
        self.setup(kind)

    @classmethod
    def of(cls, pieces, kind=UNIGRAM, dummy=True, squeeze=False):
        """A model from a list of (piece, score, type)."""
        self = cls.__new__(cls)
        self.pieces, self.dummy, self.squeeze = list(pieces), dummy, squeeze
        self.setup(kind)
        return self

    def setup(self, kind: int) -> None:
        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and merge models are supported")
        if any(t == USER for _, _, t in self.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        self.merges = kind == BPE
        self.unk = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), None)
        self.byte = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(self.pieces) if t == BYTE}
        normal = [(p, s, i) for i, (p, s, t) in enumerate(self.pieces) if t == NORMAL]
        self.id = {p: i for p, _, i in normal}
        # the better score merges first
        self.rank = {p: k for k, (p, _, _) in enumerate(sorted(normal, key=lambda x: (-x[1], x[2])))}
        self.weight = {i: 1.0 if self.merges else -s for _, s, i in normal}
        self.unk_weight = 10 - min((s for _, s, _ in normal), default=0.0)
        self.split_at_marks = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.id)
        self.spines: dict[int, tuple[list, list]] = {}
        if self.merges:
            self.parts = {p: self.derive(p) for p in self.id}
        # transducer: prefix -> piece id, or -1 inside; pieces that merging cannot make have no arc
        self.table: dict[str, int] = {}
        for p, i in self.id.items():
            if not self.merges or self.parts[p] is not None:
                for n in range(1, len(p)):
                    self.table.setdefault(p[:n], -1)
                self.table[p] = i
        self.neighbours: dict[int, bool] = {}
        self.words, self.stretches = Cache(lambda w: self.path(MARK + w)), Cache(self.path)
        self.surface = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL
                        else " ⁇ ".encode() if t == UNKNOWN else p.replace(MARK, " ").encode()
                        for p, _, t in self.pieces]

    # ------------------------------------------------------- merge models

    def derive(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes a piece, ('', '') for one character,
        None if merging its characters ends in something else."""
        parts, last = list(piece), ("", "")
        while len(parts) > 1:
            best = min(((self.rank.get(a + b, INF), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best[0] == INF:
                return None
            k = best[1]
            last = parts[k], parts[k + 1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return last

    def spine(self, i: int) -> tuple[list, list]:
        """What stands at the piece's left and right end while it is merged:
        (symbol, rank of the merge that takes it in), smallest first."""
        if i not in self.spines:
            out = []
            for side in (0, 1):
                p, until, way = self.pieces[i][0], INF, []
                while True:
                    way.append((p, until))
                    if not (self.parts.get(p) or ("", ""))[0]:
                        break
                    until, p = self.rank[p], self.parts[p][side]
                out.append(way[::-1])
            self.spines[i] = tuple(out)
        return self.spines[i]

    def may_follow(self, u: int, v: int) -> bool:
        """Would merging the joint string end in u and v? Merges happen by
        rank, so walk both edges in that order; a merge across the border that
        comes before the next one on either side (the left one wins a tie)
        breaks the pair."""
        key = u << 32 | v
        ok = self.neighbours.get(key)
        if ok is None:
            right, left, i, j = self.spine(u)[1], self.spine(v)[0], 0, 0
            while True:
                (a, na), (b, nb) = right[i], left[j]
                m = self.rank.get(a + b)
                if m is not None and m < na and m <= nb:
                    ok = False
                    break
                if na == INF and nb == INF:
                    ok = True
                    break
                if na <= nb:
                    i += 1
                else:
                    j += 1
            if len(self.neighbours) >= CACHE:
                self.neighbours.clear()
            self.neighbours[key] = ok
        return ok

    # ------------------------------------------------------- composition

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return (MARK if self.dummy and text else "") + text.replace(" ", MARK)

    def arcs(self, s: str, i: int) -> list[tuple[int, int]]:
        """(piece, end) of the lattice's arcs from position i, longest last. A
        character without a piece of its own has an arc (-2) that is spelled
        in bytes, or unknown."""
        out, get = [] if s[i] in self.id else [(-2, i + 1)], self.table.get
        for j in range(i + 1, len(s) + 1):
            piece = get(s[i:j])
            if piece is None:
                break
            if piece >= 0:
                out.append((piece, j))
        return out

    def path(self, s: str) -> list[int]:
        """Shortest path through the lattice of one stretch, as piece ids."""
        out: list[int] = []
        for piece, i in self.merge_path(s) if self.merges else self.cheapest_path(s):
            if piece == -2:
                out += [self.byte.get(b, self.unk) for b in s[i].encode()] if self.byte else [self.unk]
            else:
                out.append(piece)
        return out

    def cheapest_path(self, s: str) -> list[tuple[int, int]]:
        """(piece, start) along the path of least weight: positions are the
        states, in order."""
        n = len(s)
        cost, came = [0.0] + [INF] * n, [(-1, 0)] * (n + 1)
        for i in range(n):
            for piece, j in self.arcs(s, i):
                w = cost[i] + (self.unk_weight if piece < 0 else self.weight[piece])
                if w < cost[j]:
                    cost[j], came[j] = w, (piece, i)
        out, j = [], n
        while j:
            out.append(came[j])
            j = came[j][1]
        return out[::-1]

    def merge_path(self, s: str) -> list[tuple[int, int]]:
        """(piece, start) along the one path of finite weight. A state is a
        position with the piece before it; since each prefix has one finite
        path, a position is entered once, and one from which no arc is finite
        is dead for good. Longest arcs go first."""
        n, follows, may_follow = len(s), self.neighbours.get, self.may_follow
        out: list[tuple[int, int]] = []
        pending, dead = [], set()
        i, u, arcs = 0, -1, self.arcs(s, 0)
        while True:
            while arcs:
                piece, j = arcs.pop()
                if j in dead:
                    continue
                if u < 0 or piece < 0 or (ok := follows(u << 32 | piece)) or ok is None and may_follow(u, piece):
                    out.append((piece, i))
                    if j == n:
                        return out
                    pending.append((i, u, arcs))
                    i, u, arcs = j, piece, self.arcs(s, j)
                    break
            else:
                dead.add(i)
                i, u, arcs = pending.pop()
                out.pop()

    def encode(self, text: str) -> np.ndarray:
        """Piece ids of a text, int32."""
        if not self.split_at_marks:
            norm = self.normalise(text)
            return np.array(self.path(norm) if norm else [], np.int32)
        if self.dummy and text and MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            found = map(self.words.__getitem__, text.split(" "))
        else:
            found = map(self.stretches.__getitem__, STRETCH.findall(self.normalise(text)))
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids) -> str:
        surface = self.surface
        text = b"".join(map(surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy and text[:1] == " " else text


class Cache(dict):
    """Encodings (int32 bytes) by text, in two generations: when the newer one
    is full it becomes the older one, so what is in use stays. Long texts are
    not kept."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, s: str) -> bytes:
        out = self.older.get(s)
        if out is None:
            out = np.array(self.make(s), np.int32).tobytes()
        if len(s) <= 64:
            if len(self) >= CACHE:
                self.older = dict(self)
                self.clear()
            self[s] = out
        return out


STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_MODELS: dict[str, Model] = {}


def compiled(data: bytes) -> Model:
    key = hashlib.sha256(data).hexdigest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(data)
    return _MODELS[key]


def model_bytes(spark: SparkSession, path: str):
    """The model file, read where Spark reads, and broadcast (under 1 MB)."""
    row = spark.read.format("binaryFile").load(f"file://{path}" if path.startswith("/") else path).select("content").first()
    return spark.sparkContext.broadcast(bytes(row.content))


def encode_docs(docs: DataFrame, model_path: str = MODEL_PATH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, round_trip) of every row; ``round_trip`` tells
    whether decoding the ids gives the text back."""
    shared = model_bytes(docs.sparkSession, model_path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = compiled(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                ids, ok = [], []
                for x in part.column("text"):
                    text = x.as_py()
                    ids.append(model.encode(text))
                    ok.append(model.decode(ids[-1].tolist()) == text)
                at = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(t) for t in ids], out=at[1:])
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(ok, pa.bool_())],
                                                 names=["doc_id", "ids", "round_trip"])

    out = key_text(docs, id_col, text_col).mapInArrow(task, "doc_id long, ids array<int>, round_trip boolean")
    return out.select(restore_id(), "ids", "round_trip")


def decode_docs(encoded: DataFrame, model_path: str = MODEL_PATH, ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from ids; null ids decode to ''."""
    shared = model_bytes(encoded.sparkSession, model_path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = compiled(shared.value)
        for b in batches:
            texts = [model.decode(x.as_py() or []) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", F.col(ids_col).alias("ids")).mapInArrow(task, "doc_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_docs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


SQL = None
