"""Shared helpers of the training-data operators.

Texts reach Python as Arrow string columns; numpy reads their UTF-8 buffers
directly and every pass over bytes is vectorised. Work inside a task goes on
in pieces of bounded size, so memory does not follow the batch size. Hashes
only route and pre-select; operators whose contract is exact compare bytes
or full sets afterwards.

``doc_id`` is carried as ``long``; a null id is carried as the smallest long
and comes back as null (``restore_id``).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

NULL_ID = -(2 ** 63)
PIECE_BYTES = 1 << 20            # bytes of text that numpy works on at once
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
U64 = np.uint64
A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c) -> Column:
    """Lower-case A-Z only."""
    return F.translate(F.col(c) if isinstance(c, str) else c, A_Z, A_Z.lower())


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts go to Python in batches of at most 1000 rows: the default of
    10,000 holds tens of MB per task on either side. A session that asks for
    fewer rows keeps its setting."""
    if int(spark.conf.get(BATCH_ROWS, "10000")) > rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def key_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null ids as NULL_ID and null texts as ''; other
    columns, whatever their names, are left behind."""
    small_batches(df.sparkSession)
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def restore_id(c: str = "doc_id") -> Column:
    return F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the cluster's shared folder, read back."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0


def n_buckets(spark: SparkSession, total: int, per_bucket: int, least: int = 8) -> int:
    """Buckets that grow with the data, so that each stays of a size."""
    return int(max(least, spark.sparkContext.defaultParallelism, -(-total // per_bucket)))


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (n + 1) of an Arrow string column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if bufs[2] is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]], off - off[0]


def pieces(data: np.ndarray, off: np.ndarray, most: int = PIECE_BYTES):
    """(first row, rows' bytes, rows' offsets) of runs of whole rows of about
    ``most`` bytes; a longer row is a piece of its own."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


_POW: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse powers modulo 2**64, i < n."""
    if len(_POW[0]) < n:
        size = max(n, PIECE_BYTES + (1 << 16)) if n > 1 << 16 else 1 << 16
        inv = U64(pow(int(BASE), -1, 1 << 64))
        for k, b in enumerate((BASE, inv)):
            a = np.full(size, b, U64)
            a[0] = 1
            _POW[k] = np.cumprod(a, dtype=U64)
    return _POW[0][:n], _POW[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads the bits of a polynomial hash."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` cuts any span out of it."""
    p = np.zeros(len(values) + 1, U64)
    np.cumsum((values.astype(U64) + U64(1)) * powers(len(values))[0], out=p[1:])
    return p


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(U64))


# Byte tables. Word bytes: SPACED is [^\x20\x09-\x0D]; ALNUM is
# [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z.
_B = np.arange(256, dtype=np.uint8)
LOWER = np.where((_B >= 0x41) & (_B <= 0x5A), _B + 32, _B).astype(np.uint8)
SPACED = ~np.isin(_B, [0x20, *range(0x09, 0x0E)])
ALNUM = ((_B >= 0x30) & (_B <= 0x39)) | ((LOWER >= 0x61) & (LOWER <= 0x7A)) | (_B >= 0x80)


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
    """Starts, ends and row numbers of the words: runs of bytes of ``is_word``
    inside one row. Separators are ASCII, so no character is cut."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    m = np.zeros(n + 2, bool)
    m[1:-1] = is_word[data]
    edge = np.zeros(n + 1, bool)
    edge[off[:-1]] = True                          # rows begin (and end) here
    inner = m[1:-1]
    starts = np.flatnonzero(inner & (~m[:-2] | edge[:-1]))
    edge[n] = True
    ends = np.flatnonzero(inner & (~m[2:] | edge[1:])) + 1
    rows = np.searchsorted(off, starts, "right") - 1
    return starts, ends, rows


def word_hashes(data: np.ndarray, off: np.ndarray, is_word: np.ndarray, lower: bool):
    starts, ends, rows = word_spans(data, off, is_word)
    p = prefix_hash(LOWER[data] if lower else data)
    return starts, ends, rows, span_hash(p, starts, ends)


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    have, out = 1, h
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal neighbours."""
    if not len(values):
        z = np.zeros(0, np.int64)
        return z, z
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.r_[0, cuts], np.r_[cuts, len(values)]


def merge_spans(key: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of the spans [start, end) of each key; touching spans merge."""
    if not len(key):
        return key, start, end
    o = np.lexsort((start, key))
    key, start, end = key[o], start[o], end[o]
    first = np.r_[True, key[1:] != key[:-1]]
    # a running maximum of ends that restarts with each key
    rank = np.cumsum(first) - 1
    width = int(end.max()) + 1
    top = np.maximum.accumulate(end + rank * width) - rank * width
    new = first.copy()
    new[1:] |= start[1:] > top[:-1]
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(key)] - 1
    return key[at], start[at], top[last]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (length[0] of them), start[1], ..."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - begin, length)


def as_blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def word_pieces(data: np.ndarray, off: np.ndarray, is_word: np.ndarray, overlap: int, most: int = PIECE_BYTES):
    """Like ``pieces``, but a row longer than ``most`` comes as several pieces
    cut between words, each of which repeats the last ``overlap`` words of the
    text before it, however long they are. Yields (first row, bytes, offsets,
    starts, ends, rows, index of the first word in its row, last piece of the
    row?)."""
    for i, d, o in pieces(data, off, most):
        if len(d) <= most or len(o) > 2:
            yield i, d, o, *word_spans(d, o, is_word), 0, True
            continue
        at, end, first = 0, 0, 0
        while True:
            end = min(len(d), end + most)
            while end < len(d) and is_word[d[end]] and is_word[d[end - 1]]:
                gap = np.flatnonzero(~is_word[d[end:end + most]])
                end = end + int(gap[0]) if len(gap) else min(len(d), end + most)
            sub = d[at:end]
            o = np.array([0, len(sub)], np.int64)
            starts, ends, rows = word_spans(sub, o, is_word)
            yield i, sub, o, starts, ends, rows, first, end == len(d)
            if end == len(d):
                break
            keep = min(overlap, len(starts))
            first += len(starts) - keep
            at = at + int(starts[len(starts) - keep]) if keep else end


HOT_SHARE = 1000


def hot_join(rows: DataFrame, entries: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``entries`` (unique in ``key``), whose
    ``size`` counts the rows of each key among ``total``. An entry with more
    than 1/1000 of the rows is hot; there are fewer than 1000 such entries,
    whatever the input, and they are broadcast. In the sort-merge join of the
    others no key holds more than 1/1000 of the rows."""
    hot = entries.where(F.col(size) * HOT_SHARE > total)
    cold = entries.where(F.col(size) * HOT_SHARE <= total)
    marked = rows.join(F.broadcast(hot), key, "left")
    return marked.where(F.col(size).isNotNull()).unionByName(
        marked.where(F.col(size).isNull()).select(*rows.columns).join(cold.hint("merge"), key, "left"))
