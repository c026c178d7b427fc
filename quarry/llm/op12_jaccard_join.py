"""Exact Jaccard join of n-gram sets by partitions of the token universe.

Every text becomes its set of word shingles, each hashed to a token; texts
with equal sets are one class, and the smallest id stands for it. Two sets R, S
of similarity num / den differ in at most (|R| + |S|) (den - num) / (den + num)
tokens. The pigeonhole does the search:

* size bands: a set of a .. 2a - 1 tokens is indexed in band a. It asks its own
  band for partners that are not larger, and the band below if that one can
  hold any.
* segments: band a cuts the universe into m(a) ranges of token values. A set's
  subset in a segment has one key, its tokens' hashes added up.
* one-deletion neighbourhoods: every ``DEEP``-th segment is also indexed under
  the keys of its subset less one token. A segment that is asked exactly finds
  partners that differ there in no token (it weighs 1); asked deeply, with its
  key among deletions and its own deletions among keys, those that differ in
  one token at most (it weighs 2). If the weights of the asked segments exceed
  the number of tokens in which partners may differ, one segment must answer.
* cost-based allocation: the corpus-wide number of index entries under every
  key is counted first. Each set then asks its cheapest segments that weigh
  enough; keys that nobody else has cost nothing and need not be asked at all,
  so a set without partners usually asks nothing, and frequent segments
  (empty ones, shared passages) are left out.

Counting: a task packs the keys of about ``ENTRIES`` entries as a piece; equal
keys of a piece are sent once, 32 bits per key, to buckets that grow with the
data. The bucket answers with the counts, and the piece allocates. A key that
a third of all texts hold is one entry per piece. The 32 bits only route: a
false meeting costs a comparison.

Verification: members of the asked keys' lists are compared by size and by a
parity bitmap of their tokens (two sets differ in at least as many tokens as
their bitmaps in bits), and decided on their full sets; ``families`` does this
without writing out pairs. Links are exact but for collisions of 64-bit token
hashes (polynomial hashes of words, mixed; texts can be built to collide).

Defined cases: words are lower-cased (A-Z); a text with fewer words than a
shingle has its whole sequence as its one shingle; null, empty and blank texts
have an empty set and stand alone. Rows that repeat an id are versions of one
document: classes that share their smallest id count as one. A null id is the
smallest id. Empty tables give an empty result. Extra columns are ignored.
Nothing is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, cut, hot_join, key_text, mix, n_buckets, ranges, restore_id, text_bytes
from .components import components
from .families import decide, payloads, star_pairs, widen
from .op10_minhash import shingle_sets

DEEP = 32                        # every 32nd segment is indexed with its one-deletion neighbourhood
ENTRIES = 1 << 20                # keys of a piece
BUCKET_TEXT = 24 << 20           # bytes of text whose keys share a bucket, about 2 million keys
BITS = 4096                      # of the parity bitmap
GOLD = U64(0x9E3779B97F4A7C15)
EXACT, DELETED = U64(0x632BE59BD9B4E019), U64(0xD6E8FEB86659FD93)


# ------------------------------------------------------------ partition

def band(size: int) -> int:
    return 1 << (size.bit_length() - 1)


def n_segments(a: int) -> int:
    """Segments of band a: more than two sets that meet there may differ in
    tokens (less than a / 2 + 1), and some to leave out."""
    return a // 2 + 2 + a // 32


def may_differ(r: int, s: int, num: int, den: int) -> int:
    """Tokens in which sets of r and s tokens with similarity num / den differ at most."""
    return (r + s) * (den - num) // (den + num)


@lru_cache(maxsize=64)
def borders(m: int) -> np.ndarray:
    """First token value of every segment but the first."""
    return np.array([-(-(i << 64) // m) for i in range(1, m)], U64)


def salts(a: int, m: int) -> np.ndarray:
    return mix(np.arange(m, dtype=U64) * GOLD + U64(a))


class Segments:
    """Keys of a sorted token set in the partition of a band."""

    def __init__(self, g: np.ndarray, a: int):
        m = n_segments(a)
        cuts = np.searchsorted(g, borders(m))
        lo, hi = np.r_[0, cuts], np.r_[cuts, len(g)]
        weight = mix(g ^ GOLD)
        total = np.zeros(len(g) + 1, U64)
        np.cumsum(weight, out=total[1:])
        subset, salt = total[hi] - total[lo], salts(a, m)
        self.exact = mix(subset + salt + EXACT)
        deep = np.arange(0, m, DEEP)
        self.deep_size = (hi - lo)[deep]
        self.asked_deleted = mix(subset[deep] + salt[deep] + DELETED)      # the subset among others' deletions
        token = ranges(lo[deep], self.deep_size)
        less = np.repeat(subset[deep] + salt[deep], self.deep_size) - weight[token]
        self.less_exact, self.less_deleted = mix(less + EXACT), mix(less + DELETED)


def plan(size: int, num: int, den: int) -> list[tuple[int, bool, int]]:
    """(band, own?, weight to be asked) of a set: its own band comes first and
    is indexed even if nothing is to be asked there (0)."""
    a, least = band(size), -(-size * num // den)
    own = may_differ(size, size, num, den)
    out = [(a, True, own + 1 if own else 0)]           # sets that may differ in nothing are one class
    if least < a:
        out.append((a // 2, False, may_differ(size, a - 1, num, den) + 1))
    return out


def entries(g: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a set in a fixed order, which of them are indexed, and the sizes of its deep segments."""
    keys, index, sizes = [], [], []
    for a, own, _ in plan(len(g), num, den):
        s = Segments(g, a)
        parts = [s.exact, s.asked_deleted, s.less_exact] + ([s.less_deleted] if own else [])
        keys += parts
        index += [np.full(len(k), own and i in (0, 3)) for i, k in enumerate(parts)]
        sizes.append(s.deep_size)
    return np.concatenate(keys), np.concatenate(index), np.concatenate(sizes)


def allocate(size: int, deep_size: np.ndarray, others: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which entries of a set are asked. ``others``: index entries of other
    sets under each of its keys."""
    asked = np.zeros(len(others), bool)
    at = taken = 0
    for a, own, weight in plan(size, num, den):
        m = n_segments(a)
        nd = -(-m // DEEP)
        sizes = deep_size[taken:taken + nd]
        t = int(sizes.sum())
        cost = others[at:at + m].astype(np.int64)
        # the second unit of a deep segment: its key among deletions, its deletions among keys
        more = others[at + m:at + m + nd].astype(np.int64)
        np.add.at(more, np.repeat(np.arange(nd), sizes), others[at + m + nd:at + m + nd + t])
        deep = np.arange(0, m, DEEP)
        unit = np.r_[cost, np.maximum(more, cost[deep])]                  # never before the first unit
        best = np.argsort(unit, kind="stable")[:weight]
        once, twice = best[best < m], best[best >= m] - m
        asked[at + once] = True
        asked[at + m + twice] = True
        picked = np.zeros(nd, bool)
        picked[twice] = True
        asked[at + m + nd:at + m + nd + t] = np.repeat(picked, sizes)
        at += m + nd + t * (2 if own else 1)
        taken += nd
    return asked & (others > 0)


# ------------------------------------------------------------ sets and pieces

SIGNED = "doc_id long, text_key long, n_shingles long, set_key binary"


def digest(g: np.ndarray) -> bytes | None:
    return hashlib.blake2b(g.tobytes(), digest_size=16).digest() if len(g) else None


def signing(k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [(len(g), digest(g)) for g in shingle_sets(b, k)]
            n, keys = zip(*sets) if sets else ((), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(n, pa.int64()), pa.array(keys, pa.binary())],
                                             names=["doc_id", "text_key", "n_shingles", "set_key"])
    return task


PACKED = ["bucket", "piece", "payload", "docs"]


class Piece:
    """Classes of a run of texts and their keys."""

    def __init__(self):
        self.class_of: dict[bytes, int] = {}
        self.first: list[tuple[int, int, int]] = []          # (doc_id, text_key, size), the smallest id of each class
        self.sets: list[tuple] = []
        self.size = 0

    def add(self, doc: int, text_key: int, g: np.ndarray, num: int, den: int) -> None:
        key = digest(g)
        at = self.class_of.setdefault(key, len(self.first))
        if at < len(self.first):
            self.first[at] = min(self.first[at], (doc, text_key, len(g)))
            return
        self.first.append((doc, text_key, len(g)))
        self.sets.append(entries(g, num, den))
        self.size += len(self.sets[-1][0])

    def rows(self, number: int, buckets: int) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        keys, index, sizes = (np.concatenate(x) for x in zip(*self.sets))
        # equal keys go once: entries that come first, in order, and places of the others
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        is_first = np.zeros(len(keys), bool)
        is_first[first] = True
        rank = np.cumsum(is_first) - 1
        again = rank[first[which[~is_first]]].astype(np.int32)
        n = np.bincount(which).astype(np.int32)[which[is_first]]
        indexed = np.bincount(which, weights=index).astype(np.int32)[which[is_first]]
        keys = keys[is_first]
        bucket = ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.uint32)
        head = np.array([len(self.first), len(is_first), len(keys), len(again), len(sizes)], np.int64)
        order = np.argsort(bucket, kind="stable")
        docs = np.array(self.first, np.int64).T
        whole = b"".join((head.tobytes(), docs.tobytes(), np.packbits(is_first).tobytes(), again.tobytes(),
                          np.packbits(index).tobytes(), sizes.astype(np.int32).tobytes(), bucket.tobytes()))
        out: list[list] = [[int(mix(np.array([number], U64))[0] % U64(buckets))], [number], [squeeze(whole)], [True]]
        cuts = np.r_[0, np.flatnonzero(np.diff(bucket[order])) + 1, len(order)]
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            at = order[lo:hi]
            blob = b"".join((keys[at].astype(np.uint32).tobytes(), n[at].tobytes(), indexed[at].tobytes()))
            for c, v in zip(out, (int(bucket[at[0]]), number, squeeze(blob), False)):
                c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                           pa.array(out[2], pa.binary()), pa.array(out[3], pa.bool_())], names=PACKED)


def packing(k: int, buckets: int, num: int, den: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, piece = TaskContext.get().partitionId() << 32, Piece()
        for b in batches:
            for doc, text_key, g in zip(b.column("doc_id").to_pylist(), b.column("text_key").to_pylist(), shingle_sets(b, k)):
                if len(g):
                    piece.add(doc, text_key, g, num, den)
                if piece.size >= ENTRIES:
                    yield piece.rows(number, buckets)
                    number, piece = number + 1, Piece()
        if piece.size:
            yield piece.rows(number, buckets)
    return task


ANSWER = "piece long, bucket long, payload binary, docs boolean"


def answering(t: pa.Table) -> pa.Table:
    """Per entry of a bucket the numbers of entries and of index entries under
    its key, corpus-wide; a piece's own row passes through."""
    expand, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
    number = t.column("bucket")[0].as_py()
    rows, pieces, parts = [], [], [[], [], []]
    for piece, blob, docs in zip(*(t.column(c).to_pylist() for c in ("piece", "payload", "docs"))):
        if docs:
            rows.append((piece, number, blob, True))
            continue
        x = np.frombuffer(expand(blob), np.uint8)
        u = len(x) // 12
        pieces.append((piece, u))
        for k in range(3):
            parts[k].append(x[4 * u * k:4 * u * (k + 1)].view(np.uint32 if k == 0 else np.int32))
    if pieces:
        keys, n, indexed = (np.concatenate(p) for p in parts)
        _, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, weights=n)[which]
        held = np.minimum(np.bincount(which, weights=indexed)[which], 2 ** 31 - 1).astype(np.int32)
        shared = total > 1
        at = 0
        for piece, u in pieces:
            s = shared[at:at + u]
            mine = slice(at, at + u)
            blob = np.packbits(s).tobytes() + held[mine][s].tobytes() + keys[mine][s].tobytes()
            rows.append((piece, number, squeeze(np.array([u], np.int64).tobytes() + blob), False))
            at += u
    cols = list(zip(*rows))
    return pa.Table.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                                 pa.array(cols[3], pa.bool_())], names=["piece", "bucket", "payload", "docs"])


POSTED = "key long, cid long, text_key long, asks boolean"


def posting(num: int, den: int):
    def task(t: pa.Table) -> pa.Table:
        """The shared entries of a piece's classes, and which of them ask."""
        expand = zstandard.ZstdDecompressor().decompress
        answers, x = {}, b""
        for bucket, blob, docs in zip(*(t.column(c).to_pylist() for c in ("bucket", "payload", "docs"))):
            if docs:
                x = expand(blob)
            else:
                answers[bucket] = expand(blob)
        classes, total, unique, n_again, n_sizes = np.frombuffer(x, np.int64, 5).tolist()
        at = 40

        def take(kind, n):
            nonlocal at
            a = np.frombuffer(x, kind, n, at)
            at += a.nbytes
            return a

        docs = take(np.int64, 3 * classes).reshape(3, classes)
        is_first = np.unpackbits(take(np.uint8, -(-total // 8)))[:total].astype(bool)
        again = take(np.int32, n_again)
        index = np.unpackbits(take(np.uint8, -(-total // 8)))[:total].astype(bool)
        sizes, bucket = take(np.int32, n_sizes), take(np.uint32, unique)
        # answers stand in bucket order, and inside a bucket in entry order
        order = np.argsort(bucket, kind="stable")
        held, key = np.zeros(unique, np.int64), np.zeros(unique, np.int64)
        shared = np.zeros(unique, bool)
        lo = 0
        for b in sorted(answers):
            blob = answers[b]
            u = int(np.frombuffer(blob, np.int64, 1)[0])
            bits = -(-u // 8)
            s = np.unpackbits(np.frombuffer(blob, np.uint8, bits, 8))[:u].astype(bool)
            hit = order[lo:lo + u][s]
            raw = np.frombuffer(blob, np.uint8, offset=8 + bits)
            half = len(raw) // 2
            shared[hit] = True
            held[hit] = raw[:half].view(np.int32)
            key[hit] = np.int64(b) << 32 | raw[half:].view(np.uint32).astype(np.int64)
            lo += u
        place = np.empty(total, np.int64)
        place[is_first] = np.arange(unique)
        place[~is_first] = again
        held, key, shared = held[place], key[place], shared[place]
        out_key, out_class, out_ask = [], [], []
        at = taken = 0
        for c, size in enumerate(docs[2].tolist()):
            n = deep = 0
            for a, own, _ in plan(size, num, den):
                m = n_segments(a)
                nd = -(-m // DEEP)
                n += m + nd + int(sizes[taken + deep:taken + deep + nd].sum()) * (2 if own else 1)
                deep += nd
            mine = slice(at, at + n)
            others = np.where(shared[mine], held[mine] - index[mine], 0)
            asked = allocate(size, sizes[taken:taken + deep], others, num, den)
            give = np.flatnonzero(asked | (index[mine] & shared[mine]))
            out_key.append(key[mine][give])
            out_ask.append(asked[give])
            out_class.append(np.full(len(give), c))
            at += n
            taken += deep
        row = np.concatenate(out_class)
        return pa.Table.from_arrays([pa.array(np.concatenate(out_key)), pa.array(docs[0][row]), pa.array(docs[1][row]),
                                     pa.array(np.concatenate(out_ask))], names=[c.split()[0] for c in POSTED.split(", ")])
    return task


# ------------------------------------------------------------ verification

def bitmap(g: np.ndarray) -> bytes:
    """Size and parity bitmap of a set."""
    odd = np.bincount((mix(g + GOLD) % U64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.array([len(g)], np.int64).tobytes() + np.packbits(odd.astype(np.uint8)).tobytes()


def agreeing(num: int, den: int):
    """May sets be similar, by their sizes and the bits in which their bitmaps differ?"""
    def agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = np.ascontiguousarray(a).view(U64), np.ascontiguousarray(b).view(U64)
        m, n = a[:, 0].astype(np.int64), b[:, 0].astype(np.int64)
        ok = np.minimum(m, n) * den >= np.maximum(m, n) * num
        i = np.flatnonzero(ok)
        ok[i] = np.bitwise_count(a[i, 1:] ^ b[i, 1:]).sum(1, dtype=np.int64) <= may_differ(m[i], n[i], num, den)
        return ok
    return agree


def full_sets(k: int):
    def task(batches):
        for b in batches:
            sets = list(shingle_sets(b, k))
            yield pa.RecordBatch.from_arrays([b.column("cid"), pa.array([bitmap(g) for g in sets], pa.binary()),
                                              pa.array([g.tobytes() for g in sets], pa.binary())], names=["cid", "payload", "set"])
    return task


def asked_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the lists that someone asks and that hold someone else. Sorted by
    key, who asks first: so a list's first row tells whether it is asked, and
    it waits for the second."""
    here, first = None, None
    for b in batches:
        if not b.num_rows:
            continue
        key, cid, asks = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "cid", "asks"))
        new = np.r_[here is None or key[0] != here[0], key[1:] != key[:-1]]
        at = np.flatnonzero(new)
        lead = np.cumsum(new) - 1                                       # -1: the list of the batch before goes on
        asked = np.where(lead >= 0, asks[at[np.maximum(lead, 0)]] if len(at) else False, here[1] if here else False)
        size = np.bincount(lead + 1, minlength=len(at) + 1)[lead + 1]
        last = lead == len(at) - 1
        keep = asked & ((size > 1) | (lead < 0))
        out = [key[keep], cid[keep]]
        if first is not None and (lead < 0).any():                      # the row that waited has company
            if here[1]:
                out = [np.r_[first[0], out[0]], np.r_[first[1], out[1]]]
            first = None
        if len(at) and last.sum() == 1:
            first = (key[-1], cid[-1])
        elif len(at):
            first = None
        here = (key[-1], bool(asked[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], names=["key", "cid"])


# ------------------------------------------------------------ operator

def jaccard_components(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) of every row: components
    of the links with den * shared >= num * union on sets of ``shingle`` words."""
    if num * 100 < 80 * den:
        raise ValueError("the partition is made for similarities of 0.8 and more")
    spark = docs.sparkSession
    keyed = key_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    signed = cut(keyed.mapInArrow(signing(shingle), SIGNED), "jaccard-signed")
    classes = cut(signed.where("n_shingles > 0").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.count("*").alias("n"))
        .select("set_key", F.col("first.doc_id").alias("cid"), F.col("first.text_key").alias("text_key"), "n"), "jaccard-classes")
    heads = classes.select("cid", "text_key").distinct()
    buckets = n_buckets(spark, text_bytes(docs, text_col), BUCKET_TEXT)
    posted = (keyed.mapInArrow(packing(shingle, buckets, num, den), "bucket long, piece long, payload binary, docs boolean")
              .groupBy("bucket").applyInArrow(answering, ANSWER)
              .groupBy("piece").applyInArrow(posting(num, den), POSTED))
    # pieces hold a class of their own for each set: only the corpus-wide first one stays
    posted = posted.join(heads, ["cid", "text_key"], "left_semi").select("key", "cid", "asks")
    posted = cut(posted.repartition("key").sortWithinPartitions("key", F.desc("asks"), "cid").mapInArrow(asked_lists, "key long, cid long")
                 .distinct(), "jaccard-lists")
    # their number grows with the input, so the texts go by sort-merge at any size
    wanted = cut(heads.join(posted.select("cid").distinct(), "cid", "left_semi").withColumnRenamed("cid", "doc_id"), "jaccard-wanted")
    sets = cut(keyed.join(wanted.hint("merge"), ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])
               .select(F.col("doc_id").alias("cid"), "text").mapInArrow(full_sets(shingle), "cid long, payload binary, set binary"), "jaccard-sets")
    agree, bitmaps = agreeing(num, den), sets.select("cid", "payload")
    pairs = cut(star_pairs(posted, bitmaps, agree), "jaccard-star")
    families = widen(posted, bitmaps, pairs, agree)
    links = decide(families, pairs, sets.select("cid", "set"), num, den)
    labels = components(links)
    found = classes.join(labels.withColumnRenamed("id", "cid"), "cid", "left").select(
        "set_key", F.coalesce("comp", "cid").alias("component_id"), "n", "cid").where("n > 1 OR component_id <> cid").drop("cid")
    found = cut(found, "jaccard-found")
    base = signed.select("doc_id", "text_key", "n_shingles", "set_key")
    return hot_join(base, found, "set_key", "n", base.count()).select(
        "doc_id", "text_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(restore_id(), "n_shingles", restore_id("component_id"))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM d, unnest(range(1, greatest(2, len(w) - 3))) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) c USING (doc_id)
"""
