"""Language-model scores: a unigram base and a log-bilinear neural model.

Gathering. Each task sends, per word bucket, the distinct word hashes of a
piece of text with their training counts. A bucket adds the counts of its words
over the whole corpus and answers every piece with the counts of its words, so
no table of all words exists in one place and a frequent word, the end
included, is one entry per piece. The documents that hold the words stay in one
row per piece; it passes through a bucket chosen by the piece's number, and meets
the answers in a group of its own. Bigram counts over
the model's vocabulary come from all training tokens, combined per task.

Model. Vocabulary: the ``VOCAB`` most frequent training tokens (ties by hash),
one class for all other words, and the end. A context word has a feature
vector, mapped by one matrix; its product with a target's vector plus the
target's bias is the score (log-bilinear, context of one word). It is trained
in numpy by noise-contrastive estimation against the unigram distribution: the
data term runs over all bigram counts, and the noise term is taken in
expectation, not by samples. Scoring normalises: for the contexts of a piece
one matrix product gives all scores, and a softmax the log-probabilities. A
word of the other class has the class's probability times its share of the
class, (c + 1) / (n + v + 1) over the class's n tokens and v words, so the
model is a distribution over texts.

Defined cases: null and empty texts are one end token. Tokens are compared as
64-bit polynomial hashes of their lower-cased (A-Z) bytes, so words built to
collide under them count as one. Without training text every count is 0. A null id is the empty text for the fold and stays null. Repeated
rows count as often as they stand and are scored each. Long texts come in
pieces between words. Empty tables give an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (LOWER, NULL_ID, SPACED, U64, cut, key_text, n_buckets, prefix_hash, restore_id, runs, span_hash, text_bytes,
                     utf8, word_pieces)

VOCAB = 1024
DIM = 48
STEPS = 120
PRIOR = 5.0                    # strength of the prior that keeps vectors small, in tokens
NOISE = 10                     # noise samples per token, in expectation
BUCKET_BYTES = 32 << 20        # text per word bucket
END = U64(0x9E3779B97F4A7C15)
LOG10 = float(np.log(10))
UNK, FIRST = 0, 1              # ids: other words, then the vocabulary; the beginning comes last


def fold(c: str, mod: int, rest: int):
    """crc32 of the id as text, modulo ``mod``, is ``rest``; a null id (as
    such or as NULL_ID) is the empty text."""
    text = F.when(F.col(c) != NULL_ID, F.col(c).cast("string")).otherwise("")
    return F.crc32(text) % mod == rest


def token_pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, token hashes with the ends, their rows, number of rows) in text order."""
    data, off = utf8(batch.column("text"))
    held: list[np.ndarray] = []
    for i, d, o, starts, ends, rows, _, last in word_pieces(data, off, SPACED, 0):
        h = span_hash(prefix_hash(LOWER[d]), starts, ends)
        if not last:
            held.append(h)
            continue
        n = len(o) - 1
        if held:
            h, held = np.concatenate([*held, h]), []
            rows = np.zeros(len(h), np.int64)
        at = np.searchsorted(rows, np.arange(1, n + 1))
        yield i, np.insert(h, at, END), np.insert(rows, at, np.arange(n)), n


# ------------------------------------------------------------ word counts

ASK = "bucket long, piece long, payload binary, docs binary"
ANSWER = "kind int, piece long, count long, payload binary, docs binary"
SUMS = "doc_id long, text_key long, log_sum double, n_known long"


def asking(buckets: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            ids, keys = b.column("doc_id").to_numpy(), b.column("text_key").to_numpy()
            train = b.column("train").to_numpy(zero_copy_only=False).astype(np.int64)
            for i, h, rows, n in token_pieces(b):
                words, word = np.unique(h, return_inverse=True)
                at = words % U64(buckets)
                order = np.argsort(at, kind="stable")
                rank = np.empty(len(words), np.int64)
                rank[order] = np.arange(len(words))
                words, word, at = words[order], rank[word], at[order].astype(np.int64)
                count = np.bincount(word, weights=train[i + rows], minlength=len(words)).astype(np.int32)
                pair = np.sort(word * n + rows)
                a, z = runs(pair)
                pair, times = pair[a], (z - a).astype(np.int32)
                per = np.bincount(pair // n, minlength=len(words)).astype(np.int32)
                doc = (pair % n).astype(np.int32)
                lists = b"".join((np.array([len(words), len(doc), n], np.int64).tobytes(), per.tobytes(), doc.tobytes(), times.tobytes()))
                spread = (piece * int(END) % 2 ** 64 >> 32) % buckets
                out: list[list] = [[spread], [piece], [squeeze(lists)], [np.r_[ids[i:i + n], keys[i:i + n]].tobytes()]]
                for lo, hi in zip(*(x.tolist() for x in runs(at))):
                    blob = words[lo:hi].tobytes() + count[lo:hi].tobytes()
                    for c, v in zip(out, (int(at[lo]), piece, squeeze(blob), b"")):
                        c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                                  pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
                                                 names=["bucket", "piece", "payload", "docs"])
                piece += 1
    return task


def answering(top: int):
    def bucket(table: pa.Table) -> pa.Table:
        expand, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        number = table.column("bucket")[0].as_py()
        asks, rows = [(np.zeros(0, U64), np.zeros(0, np.int32))], []
        pieces = []
        for blob, piece, docs in zip(*(table.column(c).to_pylist() for c in ("payload", "piece", "docs"))):
            if docs:                                       # a piece's documents pass through
                rows.append((3, piece, 0, blob, docs))
                continue
            x = expand(blob)
            u = len(x) // 12
            asks.append((np.frombuffer(x, U64, u), np.frombuffer(x, np.int32, u, 8 * u)))
            pieces.append(piece)
        words, which = np.unique(np.concatenate([a[0] for a in asks]), return_inverse=True)
        count = np.bincount(which, weights=np.concatenate([a[1] for a in asks]), minlength=len(words)).astype(np.int64)
        rows.append((2, int((count > 0).sum()), int(count.sum()), b"", b""))
        best = np.lexsort((words, -count))[:top]
        rows += [(1, int(words[k].view(np.int64)), int(count[k]), b"", b"") for k in best if count[k] > 0]
        at = 0
        for (u, _), piece in zip(asks[1:], pieces):
            rows.append((0, piece, number, squeeze(count[which[at:at + len(u)]].tobytes()), b""))
            at += len(u)
        cols = list(zip(*rows))
        return pa.Table.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                                     pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary())],
                                    names=["kind", "piece", "count", "payload", "docs"])
    return bucket


def summing(table: pa.Table) -> pa.Table:
    """The counts of a piece's words, added up per document."""
    expand = zstandard.ZstdDecompressor().decompress
    answers, docs, x = [], b"", b""
    for kind, number, blob, d in zip(*(table.column(c).to_pylist() for c in ("kind", "count", "payload", "docs"))):
        if kind == 3:
            x, docs = expand(blob), d
        else:
            answers.append((number, expand(blob)))
    count = np.frombuffer(b"".join(blob for _, blob in sorted(answers)), np.int64)       # words stand in bucket order
    u, p, n = np.frombuffer(x, np.int64, 3).tolist()
    per, doc, times = (np.frombuffer(x, np.int32, k, at) for k, at in ((u, 24), (p, 24 + 4 * u), (p, 24 + 4 * u + 4 * p)))
    mine = np.repeat(count, per)
    total = np.bincount(doc, weights=times * np.log10(mine + 1.0), minlength=n)
    known = np.bincount(doc, weights=times * (mine > 0), minlength=n).astype(np.int64)
    ids, keys = np.frombuffer(docs, np.int64).reshape(2, n)
    return pa.Table.from_arrays([pa.array(ids), pa.array(keys), pa.array(total), pa.array(known)],
                                names=["doc_id", "text_key", "log_sum", "n_known"])


# ------------------------------------------------------------ model

@dataclass
class Counts:
    """Corpus counts: training tokens, distinct words, and the vocabulary."""
    tokens: int
    words: int
    vocab: np.ndarray           # hashes, sorted
    vocab_count: np.ndarray

    def ids(self, h: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.vocab, h)
        at[at == len(self.vocab)] = 0
        return np.where(self.vocab[at] == h, at + FIRST, UNK)

    @property
    def size(self) -> int:
        return len(self.vocab) + FIRST

    def smoothing(self) -> np.ndarray:
        """What the base's rule adds to the count of each target: one per
        word, and one for a word never seen."""
        return np.r_[self.other()[1] + 1.0, np.ones(len(self.vocab))]

    def other(self) -> tuple[int, int]:
        """Training tokens and distinct words outside the vocabulary."""
        return self.tokens - int(self.vocab_count.sum()), self.words - int((self.vocab_count > 0).sum())


def contexts(ids: np.ndarray, rows: np.ndarray, begin: int) -> np.ndarray:
    """The id before each token; ``begin`` at the start of a text."""
    c = np.empty_like(ids)
    c[1:] = ids[:-1]
    c[np.r_[True, rows[1:] != rows[:-1]]] = begin
    return c


def bigram_counts(keyed: DataFrame, counts: Counts) -> np.ndarray:
    """Context x target counts of all training tokens."""
    n = counts.size
    shared = keyed.sparkSession.sparkContext.broadcast(counts)      # VOCAB words

    def task(batches):
        c: Counts = shared.value
        total = np.zeros((n + 1) * n, np.int64)
        for b in batches:
            for _, h, rows, _ in token_pieces(b):
                ids = c.ids(h)
                total += np.bincount(contexts(ids, rows, n) * n + ids, minlength=len(total))
        cell = np.flatnonzero(total)
        for k in range(0, len(cell), 50_000):
            part = cell[k:k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["cell", "n"])

    cells = (keyed.where("train").select("text").mapInArrow(task, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())           # at most (VOCAB + 3) squared rows
    out = np.zeros((n + 1) * n)
    out[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return out.reshape(n + 1, n)


class LogBilinear:
    """Scores target given context: (context vector . matrix) . target vector + bias."""

    def __init__(self, contexts: int, targets: int, dim: int = DIM, seed: int = 7):
        r = np.random.default_rng(seed)
        self.q = r.normal(0, 0.1, (contexts, dim))
        self.c = np.eye(dim) + r.normal(0, 0.01, (dim, dim))
        self.r = r.normal(0, 0.1, (targets, dim))
        self.b = np.zeros(targets)

    def train(self, bigrams: np.ndarray, smoothing: np.ndarray, steps: int = STEPS, noise: int = NOISE, rate: float = 0.03,
              prior: float = PRIOR) -> None:
        """Noise-contrastive estimation by Adam. ``bigrams`` are counts; the
        pseudo-counts ``smoothing`` are spread over the contexts by their size,
        so an untrained model gives the base's probabilities."""
        total = bigrams.sum()
        share = bigrams.sum(1, keepdims=True) / total if total else np.full((len(bigrams), 1), 1 / len(bigrams))
        data = bigrams + share * smoothing
        decay = prior / data.sum()
        data /= data.sum()
        pn = data.sum(0)
        self.b = np.log(pn)
        null = noise * data.sum(1, keepdims=True) * pn[None, :]
        shift = np.log(noise * pn)[None, :]
        params = [self.q, self.c, self.r, self.b]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for t in range(1, steps + 1):
            h = self.q @ self.c
            s = h @ self.r.T + self.b - shift
            p = 1 / (1 + np.exp(-np.clip(s, -30, 30)))           # the pair is data, not noise
            g = data * (1 - p) - null * p                        # gradient of the objective by score
            gh = g @ self.r
            grads = [gh @ self.c.T - decay * self.q, self.q.T @ gh, g.T @ h - decay * self.r, g.sum(0)]
            step = rate * min(1.0, 2 * (1 - t / (steps + 1)))
            for k, (x, d) in enumerate(zip(params, grads)):
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                x += step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-10)

    def log10(self, context: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of all targets after each context."""
        s = (self.q[context] @ self.c) @ self.r.T + self.b
        s -= s.max(1, keepdims=True)
        return (s - np.log(np.exp(s).sum(1, keepdims=True))) / LOG10


def model_sums(keyed: DataFrame, counts: Counts, model: LogBilinear) -> DataFrame:
    """Per row: model log10 sum, vocabulary part of the count logs, tokens, other words."""
    shared = keyed.sparkSession.sparkContext.broadcast((counts, model))
    n = counts.size

    def task(batches):
        c, m = shared.value
        count_log = np.r_[0.0, np.log10(c.vocab_count + 1.0)]
        for b in batches:
            out = np.zeros((4, b.num_rows))
            for i, h, rows, k in token_pieces(b):
                ids = c.ids(h)
                before = contexts(ids, rows, n)
                used, which = np.unique(before, return_inverse=True)
                p = m.log10(used)[which, ids]
                for o, w in zip(out, (p, count_log[ids], None, ids == UNK)):
                    o[i:i + k] = np.bincount(rows, weights=w, minlength=k)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(out[0]), pa.array(out[1]),
                 pa.array(out[2].astype(np.int64)), pa.array(out[3].astype(np.int64))],
                names=["doc_id", "text_key", "model", "vocab_log", "n_tokens", "n_other"])

    return keyed.select("doc_id", "text_key", "text").mapInArrow(
        task, "doc_id long, text_key long, model double, vocab_log double, n_tokens long, n_other long")


def score_texts(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", vocab: int = VOCAB) -> DataFrame:
    """One row per row of ``docs``, learning from the rows where the column
    expression ``train`` (over doc_id) holds: (doc_id, n_tokens, n_known,
    train_tokens, base_score, score)."""
    spark = docs.sparkSession
    keyed = key_text(docs, id_col, text_col).withColumns(
        {"text_key": F.xxhash64("text"), "train": F.coalesce(train, F.lit(False))})
    buckets = n_buckets(spark, text_bytes(keyed), BUCKET_BYTES)
    asked = keyed.mapInArrow(asking(buckets), ASK)
    answers = cut(asked.groupBy("bucket").applyInArrow(answering(vocab), ANSWER), "lm-answers")
    size = answers.where("kind = 2").agg(F.sum("piece").alias("words"), F.sum("count").alias("tokens")).first()
    top = answers.where("kind = 1").orderBy(F.desc("count"), "piece").limit(vocab).select("piece", "count").collect()
    listed = {int(np.int64(r["piece"]).view(U64)): r["count"] for r in top}
    listed.setdefault(int(END), 0)
    order = sorted(listed)
    counts = Counts(size.tokens or 0, size.words or 0, np.array(order, U64), np.array([listed[h] for h in order], np.int64))
    bigrams = bigram_counts(keyed, counts)
    model = LogBilinear(counts.size + 1, counts.size)
    model.train(bigrams, counts.smoothing())
    sums = (answers.where("kind IN (0, 3)").groupBy("piece").applyInArrow(summing, SUMS).dropDuplicates(["doc_id", "text_key"]))
    rows = model_sums(keyed, counts, model).join(sums, ["doc_id", "text_key"])
    n, v = counts.other()
    return rows.select(
        "doc_id", "n_tokens", "n_known", F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("log_sum") - F.col("n_tokens") * F.lit(float(np.log10(counts.tokens + counts.words + 1)))).alias("base_score"),
        (F.col("model") + F.col("log_sum") - F.col("vocab_log") - F.col("n_other") * F.lit(float(np.log10(n + v + 1)))).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = score_texts(docs, ~fold("doc_id", 7, 2)).withColumn("doc_id", restore_id())
    return out.select("doc_id", fold("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


SQL = None
