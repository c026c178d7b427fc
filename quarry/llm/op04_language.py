"""Language identification by string kernels.

A text is lower-cased (A-Z), every byte that is no letter becomes a space, and
it is cut into chunks of ``CHUNK`` bytes. A chunk's features are the byte
n-grams of 1 to 3 bytes that it holds (a blended spectrum, presence only),
hashed to ``DIMS`` dimensions. The kernel of two chunks is the number of
shared features over the geometric mean of their counts.

Learning: ``LANDMARKS`` chunks per language are the Nyström landmarks; kernel
values against them, whitened by the inverse root of the landmarks' own kernel
matrix, are the inputs of one-versus-rest ridge regression, solved in closed
form. The fit uses the first ``FIT_CHUNKS`` distinct chunks of each language in
the order of the chunks' hash over the whole labelled corpus, so copies take no
place and every language with a text is learned; that bound is a parameter, and
what reaches the driver is bounded by it.

Scoring: each task fills presence rows of a block of chunks and multiplies
them with the landmarks' features and the regression weights (two matrix
products per block). A document's score per language is the mean over all its
chunks, weighted by their length; nothing is cut off.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
ties go to the first language in order; rows with null language teach nothing;
without any labelled row every text is ``und``. A null id is the empty text
for the fold and stays null. Repeated rows are scored each. Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, NULL_ID, cut, key_text, pieces, restore_id, small_batches, utf8

CHUNK = 4096
DIMS = 1 << 15
GRAMS = (1, 2, 3)
LANDMARKS = 32          # per language
FIT_CHUNKS = 400        # per language, the bound of the labelled sample
RIDGE = 1e-2
BLOCK = 64              # chunks per matrix product
MAX_LANGUAGES = 1000
MIN_SCORE = 0.25        # below, ``known_language`` rejects; not reached with four languages or fewer
UND = "und"

_B = np.arange(256)
CLEAN = np.where(((LOWER >= 0x61) & (LOWER <= 0x7A)) | (_B >= 0x80), LOWER, 0x20).astype(np.uint8)
HAS_LETTER = r"\p{L}"


def features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Presence rows (bool, DIMS wide) of the chunks [start, end) of ``raw``,
    which lie one after another."""
    lo = int(starts[0])
    t = CLEAN[raw[lo:int(ends[-1])]].astype(np.uint32)
    size = ends - starts
    row = np.repeat(np.arange(len(starts), dtype=np.int64) * DIMS, size)
    left = np.repeat(ends - lo, size) - np.arange(len(t))            # bytes to the chunk's end
    out = np.zeros(len(starts) * DIMS, bool)
    code = np.zeros(len(t), np.uint32)
    for n in GRAMS:
        code = (code << np.uint32(8))
        code[:len(t) - n + 1] |= t[n - 1:]
        h = ((code * np.uint32(0x9E3779B1)) ^ np.uint32(n * 0x15EBCA6B)) * np.uint32(0xC2B2AE35)
        ok = left >= n
        out[(row + (h >> np.uint32(32 - 15)).astype(np.int64))[ok]] = True
    return out.reshape(len(starts), DIMS)


def chunk_spans(off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the chunks of each row, in order."""
    n = -(-np.diff(off) // CHUNK)
    row = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = off[row] + k * CHUNK
    return start, np.minimum(start + CHUNK, off[row + 1]), row


def unit_rows(chunks: list[bytes]) -> np.ndarray:
    """Presence rows of some chunks, each of length one."""
    x = np.concatenate([features(np.frombuffer(c, np.uint8), np.array([0]), np.array([len(c)])) for c in chunks]).astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    return x


class Classifier:
    """Landmarks and regression weights."""

    def __init__(self, labels: list[str], marks: np.ndarray, weights: np.ndarray):
        self.labels, self.marks, self.weights = labels, marks, weights     # marks: DIMS x m, scaled

    @classmethod
    def fit(cls, sample: list[tuple[str, bytes]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> "Classifier":
        """``sample``: (language, chunk). The first chunks of each language
        in hash order are its landmarks."""
        sample = sorted({(lang, bytes(c)) for lang, c in sample if c}, key=lambda x: (zlib.crc32(x[1]), x[1], x[0]))
        labels = sorted({lang for lang, _ in sample})
        if not labels:
            return cls([], np.zeros((DIMS, 0), np.float32), np.zeros((0, 0), np.float32))
        y = np.array([labels.index(lang) for lang, _ in sample])
        pick = np.concatenate([np.flatnonzero(y == k)[:landmarks] for k in range(len(labels))])
        marks = unit_rows([sample[i][1] for i in pick])
        values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
        good = values > 1e-8 * values[-1]
        root = vectors[:, good] / np.sqrt(values[good])                      # whitening of the landmark kernel
        kernel = np.concatenate([unit_rows([c for _, c in sample[i:i + BLOCK]]) @ marks.T for i in range(0, len(sample), BLOCK)])
        phi = np.c_[kernel @ root, np.ones(len(sample))]
        target = np.where(y[:, None] == np.arange(len(labels)), 1.0, -1.0)
        # every language weighs the same
        w = 1.0 / np.bincount(y)[y]
        penalty = ridge * np.eye(phi.shape[1]) * w.sum() / len(labels)
        beta = np.linalg.solve(phi.T @ (phi * w[:, None]) + penalty, phi.T @ (target * w[:, None]))
        weights = np.vstack([root @ beta[:-1], beta[-1:]])
        return cls(labels, np.ascontiguousarray(marks.T), weights.astype(np.float32))

    def scores(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean regression value per row and language, -1 to 1 or so."""
        total = np.zeros((len(off) - 1, len(self.labels)))
        start, end, row = chunk_spans(off)
        for lo in range(0, len(row), BLOCK):
            s, e = start[lo:lo + BLOCK], end[lo:lo + BLOCK]
            x = features(raw, s, e).astype(np.float32)
            x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
            k = x @ self.marks
            value = k @ self.weights[:-1] + self.weights[-1]
            np.add.at(total, row[lo:lo + BLOCK], value * (e - s)[:, None])
        return total / np.maximum(np.diff(off), 1)[:, None]


def chunk_hashes(batch: pa.RecordBatch) -> Iterator[tuple[str, int, bytes]]:
    """(language, crc32, chunk) of every chunk of a batch."""
    lang = batch.column("lang").to_pylist()
    data, off = utf8(batch.column("text"))
    for s, e, r in zip(*(x.tolist() for x in chunk_spans(off))):
        c = data[s:e].tobytes()
        yield lang[r], zlib.crc32(c), c


def training_chunks(labelled: DataFrame, lang_col: str, text_col: str, most: int) -> list[tuple[str, bytes]]:
    """The first ``most`` distinct chunks per language in hash order (all, if
    there are fewer); copies count once. Chunks that share the last hash come
    along."""
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    if len(rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task's first hashes per language hold its part of the corpus's first ones
        held: dict[str, set[int]] = {}
        for b in batches:
            for lang, h, _ in chunk_hashes(b):
                held.setdefault(lang, set()).add(h)
            held = {lang: set(sorted(hs)[:most]) if len(hs) > most else hs for lang, hs in held.items()}
        pairs = [(lang, h) for lang, hs in held.items() for h in hs]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in pairs], pa.string()), pa.array([x[1] for x in pairs], pa.int64())],
                                         names=["lang", "hash"])

    first = (rows.mapInArrow(least, "lang string, hash long").distinct()
             .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).where(F.col("n") <= most))
    bound = {r.lang: r.last for r in first.groupBy("lang").agg(F.max("hash").alias("last")).collect()}

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = sorted({(lang, c) for lang, h, c in chunk_hashes(b) if h <= bound[lang]})
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())],
                                             names=["lang", "chunk"])

    drawn = rows.mapInArrow(draw, "lang string, chunk binary").dropDuplicates()
    return [(r.lang, bytes(r.chunk)) for r in drawn.collect()]


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", fit_chunks: int = FIT_CHUNKS,
        landmarks: int = LANDMARKS) -> Classifier:
    return Classifier.fit(training_chunks(labelled, lang_col, text_col, fit_chunks), landmarks)


def predict(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, lang_pred, score) of every row; text_key hashes the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # bounded by LANDMARKS and DIMS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Classifier = shared.value
        for b in batches:
            data, off = utf8(b.column("text"))
            letter = b.column("letter").to_numpy(zero_copy_only=False)
            best, top = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            if m.labels:
                for i, d, o in pieces(data, off):
                    s = m.scores(d, o)
                    best[i:i + len(s)] = s.argmax(1)
                    top[i:i + len(s)] = np.clip((s.max(1) + 1) / 2, 0, 1)
            names = np.array([*m.labels, UND], object)
            known = letter & bool(m.labels)
            lang = names[np.where(known, best, len(m.labels))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(lang.tolist(), pa.string()), pa.array(np.where(known, top, 0.0))],
                names=["doc_id", "text_key", "lang_pred", "score"])

    keyed = key_text(docs, id_col, text_col).withColumns(
        {"letter": F.col("text").rlike(HAS_LETTER), "text_key": F.xxhash64("text")})
    return keyed.mapInArrow(task, "doc_id long, text_key long, lang_pred string, score double")


def held_out(c="doc_id"):
    """The fold that is not learned from: crc32 of the id as text mod 4 is 2."""
    col = F.col(c) if isinstance(c, str) else c
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % 4 == 2


def known_language(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is told; ``und`` and scores under
    ``min_score`` go. The outputs of K languages sum to about 2 - K, so the
    best score is about 1 / K or more: with up to four languages, as in the
    tables, only ``und`` goes. All columns stay as they are."""
    model = fit(docs.where(~held_out()))
    rejected = predict(docs, model).where((F.col("lang_pred") == UND) | (F.col("score") < min_score)).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    # written first, so that the join knows their size: few go by broadcast, many by sort-merge
    rejected = cut(rejected, "language-rejected")
    keyed = docs.withColumns({"_id": F.coalesce(F.col("doc_id"), F.lit(NULL_ID)),
                              "_key": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    return keyed.join(rejected, ["_id", "_key"], "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = predict(docs, fit(docs.where(~held_out()))).withColumn("doc_id", restore_id())
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


SQL = None
