"""Suffix-array dedup of byte strings by deep-shallow sorting.

Every string of ``WINDOW`` bytes that also starts earlier (in a smaller
document, or earlier in the same one) is removed. Strings with the same
minimiser (least hash of their ``GRAM``-byte grams) meet in one bucket, packed
as in ``superkmer``; each bucket builds the suffix array of its strings:

* shallow: multikey quicksort, eight bytes per step, down to ``SHALLOW``
  bytes; after each step only the groups that still agree go on;
* deep: blind tries order the groups that agree for longer. The tries of all
  groups grow together, level by level: a node's skip is the least common
  prefix of its members, found by comparing each with the first, and the
  members branch on the bytes at that depth, so what all share is stepped over
  once.

A leaf that holds several suffixes is a string that occurs several times; all
but its first occurrence are reported. The number of buckets follows the size
of the texts, so a bucket stays at about ``BUCKET_BYTES``.

Defined cases: a null text is empty. Removed bytes may cut a character, so the
rest is binary. Rows that repeat an id are versions of one document: an
earlier start in one counts for the other, equal starts do not, and the
spans found are cut from each. A null id is the smallest id. Texts under
``WINDOW`` bytes keep everything. Empty tables give an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (PIECE_BYTES, U64, key_text, merge_spans, n_buckets, pieces, prefix_hash, ranges, restore_id, runs,
                     sliding_min, span_hash, text_bytes, utf8)
from .superkmer import (FLUSH_BYTES, PACKED, SPANS, Bundles, Unpacked, by_document, list_values, repeated, same_strings, spans_table,
                        window_runs)

WINDOW = 100
GRAM = 16
SHALLOW = 24
BUCKET_BYTES = 8 << 20


# ------------------------------------------------------------ suffix sorting

class Words:
    """Eight bytes of a text at any position, as a number that sorts like them."""

    def __init__(self, data: np.ndarray):
        self.padded = np.zeros(len(data) + 8, np.uint8)
        self.padded[:len(data)] = data
        self.view = np.ndarray((len(data) + 1,), ">u8", self.padded, strides=(1,))

    def at(self, pos: np.ndarray) -> np.ndarray:
        return self.view[pos].astype(U64)


def split_groups(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key inside each group, and where the new groups begin."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    return order, np.r_[True, (g[1:] != g[:-1]) | (k[1:] != k[:-1])] if len(g) else np.zeros(0, bool)


def sort_suffixes(data: np.ndarray, pos: np.ndarray, window: int = WINDOW, shallow: int = SHALLOW):
    """Suffix array of the positions ``pos`` by their first ``window`` bytes,
    and for each place the number of its leaf; equal strings share a leaf."""
    words = Words(data)
    sa = pos.copy()
    leaf = np.zeros(len(sa), np.int64)             # place of the first suffix of the same group
    live = np.arange(len(sa))                      # places whose group has several members
    depth = 0
    while depth < min(shallow, window) and len(live):
        key = words.at(sa[live] + depth)
        if depth + 8 > window:
            key >>= U64(8 * (depth + 8 - window))
        if depth:
            order, new = split_groups(leaf[live], key)
        else:
            order = np.argsort(key)
            k = key[order]
            new = np.r_[True, k[1:] != k[:-1]]
        sa[live] = sa[live[order]]                 # a group's places stay together
        leaf[live] = live[np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))]
        live = live[several(leaf[live])]
        depth += 8
    if depth < window:
        blind_tries(words, sa, leaf, live, depth, window)
    return sa, leaf


def several(group: np.ndarray) -> np.ndarray:
    """Members of groups of two and more; groups are runs."""
    begin, end = runs(group)
    return np.repeat(end - begin > 1, end - begin)


def blind_tries(words: Words, sa, leaf, live, depth: int, window: int) -> None:
    """Order the remaining groups below ``depth``, all tries level by level."""
    reached = np.full(len(sa), depth, np.int64)    # depth that a group shares for certain
    while len(live):
        begin, end = runs(leaf[live])
        size = end - begin
        # skip: compare each member with the first one, eight bytes a step
        common = reached[live].copy()
        going = np.flatnonzero(np.repeat(np.arange(len(live))[begin], size) != np.arange(len(live)))
        head = sa[live[np.repeat(begin, size)]]
        mine = sa[live]
        while len(going):
            d = common[going]
            x = words.at(mine[going] + np.minimum(d, window)) ^ words.at(head[going] + np.minimum(d, window))
            same = (x == 0) & (d < window)
            bytes_equal = np.where(x == 0, 8, leading_zero_bytes(x))
            common[going] = np.minimum(d + bytes_equal, window)
            going = going[same & (common[going] < window)]
        common[begin] = window
        skip = np.repeat(np.minimum.reduceat(common, begin), size)
        inner = skip < window                      # else: a leaf of equal strings
        live, skip = live[inner], skip[inner]
        if not len(live):
            return
        key = words.at(sa[live] + skip)
        over = np.maximum(skip + 8 - window, 0).astype(U64)
        key >>= U64(8) * over
        order, new = split_groups(leaf[live], key)
        sa[live] = sa[live[order]]
        leaf[live] = live[np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))]
        reached[live] = np.minimum(skip + 8, window)
        live = live[several(leaf[live])]
        live = live[reached[live] < window]


def leading_zero_bytes(x: np.ndarray) -> np.ndarray:
    n = np.zeros(len(x), np.int64)
    for k in range(1, 8):
        n += x < U64(1 << (64 - 8 * k))
    return n


# ------------------------------------------------------------ Spark stages

def byte_pieces(data: np.ndarray, off: np.ndarray, overlap: int, most: int = PIECE_BYTES):
    """Like ``pieces``; a longer row comes in parts that share ``overlap``
    bytes. Yields (first row, bytes, offsets, first byte in the row)."""
    for i, d, o in pieces(data, off, most):
        if len(o) > 2 or len(d) <= most:
            yield i, d, o, 0
        else:
            for at in range(0, len(d) - overlap, most):
                sub = d[at:at + most + overlap]
                yield i, sub, np.array([0, len(sub)], np.int64), at


def packing(buckets: int, window: int, gram: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Bundles(buckets, within=True)
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            data, off = utf8(b.column("text"))
            for i, d, o, first in byte_pieces(data, off, window - 1):
                if len(d) >= window:
                    pack_piece(out, d, o, first, ids[i:], window, gram)
                out.text += len(d)
                if out.text >= FLUSH_BYTES and (rb := out.flush()):
                    yield rb
        if rb := out.flush():
            yield rb
    return task


def pack_piece(out, d, off, first, ids, window, gram) -> None:
    at = np.arange(len(d) - gram + 1)
    p = prefix_hash(d)
    h = span_hash(p, at, at + gram)
    mins = sliding_min(h, window - gram + 1)
    # a window may not reach over its row's end
    short = np.zeros(len(d) + 1, np.int64)
    np.add.at(short, np.maximum(off[:-1], off[1:] - window + 1), 1)
    np.add.at(short, off[1:], -1)
    a, b = window_runs(mins, np.cumsum(short[:len(mins)]) == 0)
    if len(a):
        row = np.searchsorted(off, a, "right") - 1
        hi = b + window - 1
        out.add(d, a, hi, span_hash(p, a, hi), mins[a], ids[row], a - off[row] + first, hi - a,
                stands_again(h, mins[a], a, b, window - gram + 1))


def stands_again(h, least, a, b, grams: int, at_once: int = 10_000) -> np.ndarray:
    """Whether a run's minimiser stands in it more than once: its first place
    is in the first window, its last place in the last one."""
    view = np.lib.stride_tricks.sliding_window_view(h, grams)
    out = np.zeros(len(a), bool)
    for k in range(0, len(a), at_once):
        s = slice(k, k + at_once)
        first = a[s] + (view[a[s]] == least[s, None]).argmax(1)
        last = b[s] - 2 + grams - (view[b[s] - 1] == least[s, None])[:, ::-1].argmax(1)
        out[s] = first != last
    return out


def merge_equal(u: Unpacked):
    """Of the bucket's equal strings the first place goes on; the others are
    covered. Returns these spans, and the strings to sort: the rest, if their
    minimiser comes in another one or again in themselves."""
    lo, hi = u.off[:-1], u.off[1:]
    cls = same_strings(u.data, lo, hi, span_hash(prefix_hash(u.data), lo, hi))
    start = u.starts[u.rep_at]
    many = np.flatnonzero(cls >= 0)
    many = many[np.lexsort((start[many], u.docs[many], cls[many]))]
    begin, end = runs(cls[many])
    head = np.repeat(many[begin], end - begin)
    stay = np.ones(len(lo), bool)
    stay[many] = many == head
    gone = many[(u.docs[many] != u.docs[head]) | (start[many] != start[head])]
    left = np.flatnonzero(stay)
    left = left[repeated(u.keys[left]) | u.again[left]]
    return (u.docs[gone], start[gone], start[gone] + (hi - lo)[gone]), left


def sorting(window: int):
    def bucket(table: pa.Table) -> pa.Table:
        u = Unpacked(table)
        doc, s, e = u.cover
        if len(u.docs):
            (gd, a, b), left = merge_equal(u)
            doc, s, e = np.r_[doc, gd], np.r_[s, a], np.r_[e, b]
            n = np.diff(u.off)[left] - window + 1                  # windows of each string
            sa, leaf = sort_suffixes(u.data, ranges(u.off[left], n), window)
            # all places of a leaf but the first occurrence
            many = several(leaf)
            sa, leaf = sa[many], leaf[many]
            row = np.searchsorted(u.off, sa, "right") - 1
            d, start = u.docs[row], u.starts[u.rep_at[row]] + sa - u.off[row]
            order = np.lexsort((start, d, leaf))
            begin, end = runs(leaf[order])
            head = np.repeat(order[begin], end - begin)
            gone = order[(d[order] != d[head]) | (start[order] != start[head])]
            gd, a, b = merge_spans(d[gone], start[gone], start[gone] + window)
            doc, s, e = np.r_[doc, gd], np.r_[s, a], np.r_[e, b]
        return spans_table(doc, s, e)
    return bucket


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, starts, ends): removal spans in bytes per document that has any."""
    keyed = key_text(docs, id_col, text_col)
    buckets = n_buckets(docs.sparkSession, 4 * text_bytes(keyed), bucket_bytes)
    packed = keyed.mapInArrow(packing(buckets, window, min(gram, window)), PACKED)
    return by_document(packed.groupBy("bucket").applyInArrow(sorting(window), SPANS))


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of every row."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, off = utf8(b.column("text"))
            ns, starts = list_values(b.column("starts"))
            _, ends = list_values(b.column("ends"))
            at = np.r_[0, np.cumsum(ns)]
            for i, d, o in pieces(text, off):
                n = len(o) - 1
                size, span = np.diff(o), slice(at[i], at[i + n])
                row = np.repeat(np.arange(n), ns[i:i + n])
                s, e = np.minimum(starts[span], size[row]), np.minimum(ends[span], size[row])
                row, s, e = merge_spans(row[s < e], s[s < e], e[s < e])
                gone = np.zeros(len(d) + 1, np.int32)
                np.add.at(gone, o[row] + s, 1)
                np.add.at(gone, o[row] + e, -1)
                stay = np.cumsum(gone[:-1], dtype=np.int32) == 0
                left = o - np.r_[0, np.cumsum(np.bincount(row, weights=e - s, minlength=n).astype(np.int64))]
                kept = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(left), pa.py_buffer(d[stay])])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, n), pa.array(size), pa.array(size - np.diff(left)),
                     pa.array(np.bincount(row, minlength=n).astype(np.int64)), kept.cast(pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    keyed = key_text(docs, id_col, text_col).join(spans, "doc_id", "left")
    return keyed.mapInArrow(task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary").withColumn(
        "doc_id", restore_id())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = remove_spans(docs, repeated_spans(docs))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
b AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS byte, CASE WHEN p + 100 <= n THEN md5(substr(h, 2 * p + 1, 200)) END AS s
      FROM d, unnest(range(0, n)) AS r(p)),
m AS (SELECT s, min({'d': doc_id, 'p': p}) AS f, count(*) AS c FROM b WHERE s IS NOT NULL GROUP BY s HAVING count(*) > 1),
w AS (SELECT b.doc_id, b.p, b.byte, m.s IS NOT NULL AND (b.doc_id > m.f.d OR b.p > m.f.p) AS dup FROM b LEFT JOIN m USING (s)),
g AS (SELECT doc_id, p, byte, max(CASE WHEN dup THEN 1 ELSE 0 END) OVER
             (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM w),
e AS (SELECT *, CASE WHEN gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), 0) = 0 THEN 1 ELSE 0 END AS fresh FROM g),
a AS (SELECT doc_id, count(*) FILTER (gone = 1) AS n_removed, count(*) FILTER (fresh = 1) AS n_spans,
             coalesce(string_agg(byte, '' ORDER BY p) FILTER (gone = 0), '') AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, coalesce(a.n_removed, 0) AS n_removed, coalesce(a.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(a.kept, ''))) AS kept_sha256
FROM d LEFT JOIN a USING (doc_id)
"""
