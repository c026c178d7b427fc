"""Windows grouped into packed strings that share a minimiser.

Equal windows have the same minimiser, so consecutive windows with one
minimiser value travel as one packed string to that value's bucket and all
equal windows meet there. ``Bundles`` collects the packed strings of a task.
A string that repeats inside the task is shipped once, for its first document:
the windows of its other occurrences are covered for certain, and these spans
are known on the spot. So a passage that a third of all documents share sends
one string per task, not one per document.

Bundles reach their bucket as one row per task and bucket (zstd-compressed
bytes and arrays), and ``unpack`` puts a bucket's rows together. Strings whose
minimiser came once, and stands in them once, cannot hold a repeated window
and are left out there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, merge_spans, ranges, runs

MAX_RUN = 1024                     # windows per packed string
FLUSH_BYTES = 8 << 20              # text per bundle
CONFIRM = 1 << 20                  # bytes compared at once
LEVEL = 5                          # of zstd
PACKED = "bucket long, data binary, size long, numbers binary, cover binary"
PACKED_NAMES = [x.split()[0] for x in PACKED.split(", ")]
SPANS = "doc_id long, starts array<long>, ends array<long>"


def window_runs(mins: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[first, end) of the runs of consecutive valid windows with one minimiser."""
    at = np.flatnonzero(valid)
    if not len(at):
        z = np.zeros(0, np.int64)
        return z, z
    new = np.r_[True, (at[1:] != at[:-1] + 1) | (mins[at[1:]] != mins[at[:-1]])]
    begin = np.flatnonzero(new)
    size = np.diff(np.r_[begin, len(at)])
    if size.max() > MAX_RUN:                              # cut long runs; windows stay whole
        n = -(-size // MAX_RUN)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        begin, size = np.repeat(begin, n) + k * MAX_RUN, np.minimum(np.repeat(size, n) - k * MAX_RUN, MAX_RUN)
    return at[begin], at[begin] + size


def same_strings(data, lo, hi, h) -> np.ndarray:
    """Class number of every string data[lo:hi], -1 for strings that are
    alone; ``h`` are their hashes. Equal hashes are confirmed on bytes."""
    out = np.full(len(h), -1, np.int64)
    todo, classes, size_of = np.argsort(h), 0, hi - lo
    while len(todo):
        begin, end = runs(h[todo])
        many = end - begin > 1
        todo = todo[np.repeat(many, end - begin)]
        size = (end - begin)[many]
        if not len(size):
            break
        head = np.repeat(todo[np.cumsum(size) - size], size)
        equal = size_of[todo] == size_of[head]
        length = np.where(equal, size_of[todo], 0)
        lot = (np.cumsum(length) - length) // CONFIRM
        for k, stop in zip(*(x.tolist() for x in runs(lot))):
            t, u, n = todo[k:stop], head[k:stop], length[k:stop]
            bad = np.r_[0, np.cumsum(data[ranges(lo[t], n)] != data[ranges(lo[u], n)])]
            end_at = np.cumsum(n)
            equal[k:stop] &= bad[end_at] == bad[end_at - n]
        number = np.repeat(np.arange(len(size)) + classes, size)
        out[todo[equal]] = number[equal]
        classes += len(size)
        todo = todo[~equal]                       # other strings with the same hash
    return out


def planes(a: np.ndarray) -> bytes:
    """Differences of neighbours, byte by byte, which compress well."""
    d = np.diff(a, prepend=a[:1] * 0)
    return np.ascontiguousarray(d.view(np.uint8).reshape(len(a), -1).T).tobytes()


def from_planes(b: np.ndarray, n: int) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(b.reshape(8, n).T).view(np.int64).ravel())


class Bundles:
    """Packed strings of a task. ``within``: a window that starts earlier in
    the same document counts, too (else only smaller documents do)."""

    def __init__(self, buckets: int, within: bool):
        self.buckets, self.within, self.text = buckets, within, 0
        self.raw: list[np.ndarray] = []
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, raw: np.ndarray, lo, hi, hashes, keys, docs, starts, units, again=None) -> None:
        """Strings raw[lo:hi] with their hash, minimiser, document, first unit
        and number of units (words or bytes) covered; ``again``: does the
        minimiser stand in the string more than once?"""
        self.raw.append(raw)
        self.parts.append((lo + self.size, hi + self.size, hashes, keys, docs, starts, units,
                           np.zeros(len(lo), bool) if again is None else again))
        self.size += len(raw)

    def flush(self) -> pa.RecordBatch | None:
        """Rows of what was added since the last flush."""
        self.text = 0
        if not self.parts:
            return None
        data = np.concatenate(self.raw)
        lo, hi, hashes, keys, docs, starts, units, again = (np.concatenate(x) for x in zip(*self.parts))
        self.raw, self.parts, self.size = [], [], 0
        cls = same_strings(data, lo, hi, hashes)
        # of the strings in several places, those of the first document (within: the first place) go on
        many = np.flatnonzero(cls >= 0)
        many = many[np.lexsort((starts[many], docs[many], cls[many]))]
        begin, end = runs(cls[many])
        head = np.repeat(many[begin], end - begin)
        later = docs[many] != docs[head]
        if self.within:
            later |= starts[many] != starts[head]
        gone = many[later]
        cover = merge_spans(docs[gone], starts[gone], starts[gone] + units[gone])
        # the head stands for its string; its document's other places are repeats
        stay = np.ones(len(lo), bool)
        stay[many] = many == head
        more = many[~later & (many != head)]
        owner = head[~later & (many != head)]
        first = np.flatnonzero(stay)
        bucket = (keys[first] % U64(self.buckets)).astype(np.int64)
        first = first[np.lexsort((starts[first], docs[first], bucket))]
        bucket = (keys[first] % U64(self.buckets)).astype(np.int64)
        place = np.zeros(len(lo), np.int64)
        place[first] = np.arange(len(first))
        of = np.r_[np.arange(len(first)), place[owner]]                  # string of each place
        order = np.argsort(of, kind="stable")
        reps = np.bincount(of, minlength=len(first))
        where = np.r_[starts[first], starts[more]][order]
        at_place = np.cumsum(reps) - reps
        size = hi[first] - lo[first]
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        columns: dict[str, list] = {c: [] for c in PACKED_NAMES}
        for a, b in zip(*(x.tolist() for x in runs(bucket))):
            numbers = b"".join((
                np.array([b - a, int(reps[a:b].sum())], np.int64).tobytes(), (keys[first[a:b]] >> U64(32)).astype(np.uint32).tobytes(),
                again[first[a:b]].tobytes(), planes(size[a:b]), planes(docs[first[a:b]]), planes(reps[a:b]),
                planes(where[at_place[a]:at_place[b - 1] + reps[b - 1]])))
            mine = data[ranges(lo[first[a:b]], size[a:b])]
            for c, v in zip(PACKED_NAMES, (int(bucket[a]), squeeze(mine), len(mine), squeeze(numbers), b"")):
                columns[c].append(v)
        if len(cover[0]):
            at = np.mod(cover[0], self.buckets)
            order = np.argsort(at, kind="stable")
            for a, b in zip(*(x.tolist() for x in runs(at[order]))):
                found = np.stack([x[order[a:b]] for x in cover])
                for c, v in zip(PACKED_NAMES, (int(at[order[a]]), b"", 0, b"", squeeze(found.tobytes()))):
                    columns[c].append(v)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], pa.int64() if c in ("bucket", "size") else pa.binary()) for c in PACKED_NAMES], names=PACKED_NAMES)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys come more than once."""
    order = np.argsort(keys)
    begin, end = runs(keys[order])
    out = np.zeros(len(keys), bool)
    out[order] = np.repeat(end - begin > 1, end - begin)
    return out


class Unpacked:
    """A bucket's strings: bytes, offsets, documents, repeats and starts, and
    the spans that tasks had found covered. Strings whose minimiser came and
    stands in them once hold no repeated window and are left out."""

    def __init__(self, table: pa.Table):
        expand = zstandard.ZstdDecompressor().decompress
        z = np.zeros(0, np.int64)
        cover, keys, again, lens, docs, reps, starts = [np.zeros((3, 0), np.int64)], [], [], [z], [z], [z], [z]
        for b in table.column("cover").to_pylist():
            if b:
                cover.append(np.frombuffer(expand(b), np.int64).reshape(3, -1))
        self.cover = tuple(np.concatenate(cover, axis=1))
        counts = []
        for b in table.column("numbers").to_pylist():
            if not b:
                counts.append(0)
            else:
                x = np.frombuffer(expand(b), np.uint8)
                n, m = x[:16].view(np.int64).tolist()
                counts.append(n)
                at = np.cumsum([16, 4 * n, n, 8 * n, 8 * n, 8 * n, 8 * m])
                keys.append(x[at[0]:at[1]].view(np.uint32))
                again.append(x[at[1]:at[2]].view(bool))
                for to, k, c in ((lens, 2, n), (docs, 3, n), (reps, 4, n), (starts, 5, m)):
                    to.append(from_planes(x[at[k]:at[k + 1]], c))
        lens, docs, reps, self.starts = (np.concatenate(x) for x in (lens, docs, reps, starts))
        if not len(lens):
            self.data, self.off, self.docs, self.reps, self.rep_at = np.zeros(0, np.uint8), np.zeros(1, np.int64), z, z, z
            return
        keys, again = np.concatenate(keys), np.concatenate(again)
        keep = repeated(keys) | again
        parts, at = [], 0
        for blob, size, n in zip(table.column("data").to_pylist(), table.column("size").to_pylist(), counts):
            mine = keep[at:at + n]
            if mine.any():
                raw = np.frombuffer(expand(blob, max_output_size=size), np.uint8)
                parts.append(raw if mine.all() else raw[np.repeat(mine, lens[at:at + n])])
            at += n
        rep_at = np.cumsum(reps) - reps
        self.data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        self.docs, self.reps, self.rep_at = docs[keep], reps[keep], rep_at[keep]
        self.keys, self.again = keys[keep], again[keep]
        self.off = np.r_[0, np.cumsum(lens[keep])]


def spans_table(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    """One row per document with its merged spans."""
    doc, start, end = merge_spans(doc, start, end)
    at = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    cuts = pa.array(np.r_[at, len(doc)].astype(np.int32))
    return pa.Table.from_arrays([pa.array(doc[at]), pa.ListArray.from_arrays(cuts, pa.array(start)),
                                 pa.ListArray.from_arrays(cuts, pa.array(end))], names=["doc_id", "starts", "ends"])


def by_document(spans: DataFrame) -> DataFrame:
    """All spans of a document in one row; a document's spans are bounded by its length."""
    return spans.groupBy("doc_id").agg(F.flatten(F.collect_list("starts")).alias("starts"),
                                       F.flatten(F.collect_list("ends")).alias("ends"))


def list_values(col) -> tuple[np.ndarray, np.ndarray]:
    """Counts and values of a list<long> column; null counts as empty."""
    n = np.array([0 if x is None else x for x in pc.list_value_length(col).to_pylist()], np.int64)
    return n, np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.int64)
