"""Substring dedup of word windows by super-k-mer partitioning.

A window is 13 consecutive words of one document. Its minimiser is the least
hash of its 3-word grams; consecutive windows that share it travel as one
packed string (words joined by one space) to the minimiser's bucket
(``superkmer``). There the windows are sorted by hash, equal neighbours are
confirmed on their bytes, and every window that a smaller document also holds
is reported. The number of buckets follows the size of the texts, so a bucket
stays at about ``BUCKET_BYTES``.

Defined cases: null text has no words; documents of fewer than 13 words keep
everything. Only a smaller id counts, so a passage that repeats inside one
document stays in the document that holds it first. Rows that repeat an id are
versions of one document: they do not remove each other's words, and what
another document removes from one version is cut from each by word number. A
null id is the smallest id. Empty tables give an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (SPACED, U64, key_text, merge_spans, mix, n_buckets, pieces, prefix_hash, ranges, restore_id, sliding_min,
                     span_hash, text_bytes, utf8, word_pieces, word_spans)
from .superkmer import (FLUSH_BYTES, PACKED, SPANS, Bundles, Unpacked, by_document, list_values, same_strings, spans_table,
                        window_runs)

WINDOW = 13
GRAM = 3
BUCKET_BYTES = 8 << 20


def packing(buckets: int, window: int, gram: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Bundles(buckets, within=False)
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            data, off = utf8(b.column("text"))
            for i, d, _, starts, ends, rows, first, _ in word_pieces(data, off, SPACED, window - 1):
                if len(starts) >= window:
                    pack_piece(out, d, starts, ends, rows, first, ids[i:], window, gram)
                out.text += len(d)
                if out.text >= FLUSH_BYTES and (rb := out.flush()):
                    yield rb
        if rb := out.flush():
            yield rb
    return task


def pack_piece(out, d, starts, ends, rows, first, ids, window, gram) -> None:
    h = span_hash(prefix_hash(d), starts, ends)
    g = h[:len(h) - gram + 1].copy()
    for k in range(1, gram):
        g = g * U64(0x9E3779B97F4A7C15) + h[k:len(h) - gram + 1 + k]
    mins = sliding_min(mix(g), window - gram + 1)
    a, b = window_runs(mins, rows[:len(mins)] == rows[window - 1:])
    if not len(a):
        return
    # the piece's words joined by one space
    size = ends - starts
    at = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int(at[-1] + size[-1]), 0x20, np.uint8)
    joined[ranges(at, size)] = d[ranges(starts, size)]
    count = np.bincount(rows, minlength=int(rows[-1]) + 1)
    number = a - (np.cumsum(count) - count)[rows[a]] + first
    last = b + window - 2
    lo, hi = at[a], at[last] + size[last]
    out.add(joined, lo, hi, span_hash(prefix_hash(joined), lo, hi), mins[a], ids[rows[a]], number, b - a + window - 1)


def counting(window: int):
    def bucket(table: pa.Table) -> pa.Table:
        u = Unpacked(table)
        doc, s, e = u.cover
        if len(u.docs):
            starts, ends, rows = word_spans(u.data, u.off, SPACED)
            w = np.flatnonzero(rows[:len(rows) - window + 1] == rows[window - 1:])
            p = prefix_hash(span_hash(prefix_hash(u.data), starts, ends))
            lo, hi = starts[w], ends[w + window - 1]
            cls = same_strings(u.data, lo, hi, span_hash(p, w, w + window))
            # a window goes if its class holds a smaller document
            many = np.flatnonzero(cls >= 0)
            first = np.full(int(cls.max(initial=-1)) + 1, np.iinfo(np.int64).max)
            np.minimum.at(first, cls[many], u.docs[rows[w[many]]])
            gone = many[u.docs[rows[w[many]]] > first[cls[many]]]
            row = rows[w[gone]]
            word = w[gone] - np.searchsorted(rows, row)           # word number inside its string
            row, a, b = merge_spans(row, word, word + window)
            n = u.reps[row]
            base = u.starts[ranges(u.rep_at[row], n)]
            doc = np.r_[doc, np.repeat(u.docs[row], n)]
            s, e = np.r_[s, np.repeat(a, n) + base], np.r_[e, np.repeat(b, n) + base]
        return spans_table(doc, s, e)
    return bucket


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, starts, ends): removal spans in words per document that has any."""
    keyed = key_text(docs, id_col, text_col)
    buckets = n_buckets(docs.sparkSession, 3 * text_bytes(keyed), bucket_bytes)
    packed = keyed.mapInArrow(packing(buckets, window, gram), PACKED)
    return by_document(packed.groupBy("bucket").applyInArrow(counting(window), SPANS))


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the kept words joined by one space."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, off = utf8(b.column("text"))
            ns, s = list_values(b.column("starts"))
            _, e = list_values(b.column("ends"))
            at = np.r_[0, np.cumsum(ns)]
            for i, d, o in pieces(text, off):
                words, removed, kept = [], [], []
                for r in range(len(o) - 1):
                    raw = d[o[r]:o[r + 1]]
                    span = slice(at[i + r], at[i + r + 1])
                    starts, ends, _ = word_spans(raw, np.array([0, len(raw)], np.int64), SPACED)
                    gone = np.zeros(len(starts) + 1, np.int64)
                    np.add.at(gone, np.minimum(s[span], len(starts)), 1)
                    np.add.at(gone, np.minimum(e[span], len(starts)), -1)
                    stay = np.cumsum(gone[:-1]) == 0
                    size = ends[stay] - starts[stay]
                    put = np.cumsum(size + 1) - (size + 1)
                    out = np.full(max(0, int(size.sum()) + len(size) - 1), 0x20, np.uint8)
                    out[ranges(put, size)] = raw[ranges(starts[stay], size)]
                    words.append(len(starts))
                    removed.append(int((~stay).sum()))
                    kept.append(out.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, len(words)), pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    keyed = key_text(docs, id_col, text_col).join(spans, "doc_id", "left")
    return keyed.mapInArrow(task, "doc_id long, n_words long, n_removed long, kept string").withColumn("doc_id", restore_id())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = remove_spans(docs, repeated_spans(docs))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) AS r(i) WHERE len(w) >= 13),
m AS (SELECT s, min(doc_id) AS first_doc FROM g GROUP BY s),
gone AS (SELECT DISTINCT g.doc_id, j FROM g JOIN m USING (s), unnest(range(g.i, g.i + 13)) AS r(j) WHERE g.doc_id > m.first_doc),
k AS (SELECT d.doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS r(p)),
kept AS (SELECT k.doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM k ANTI JOIN gone ON k.doc_id = gone.doc_id AND k.p = gone.j GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
