"""Benchmark decontamination by an FM-index per training shard.

A phrase is 13 consecutive words of a benchmark item, or all words of a
shorter item. Each task cuts its documents into shards of bounded size and
indexes every shard: words become symbols, the suffix array is sorted by
doubling, the BWT goes into a wavelet tree (matrix layout) whose bit ranks are
running counts, and suffix positions are sampled. All phrases are searched
together, backwards, one step for all of them per word; the occurrences are
located by stepping back to sampled positions, confirmed on the words' bytes,
and merged into removal spans per document.

The alphabet is that of the phrases. A word outside it can be in no phrase, so
each run of such words, like the end of a document, is one separator;
separators differ from each other, which ends every comparison there, and the
symbol after a separator is always sampled, so that stepping back never
crosses one.

Nothing is shuffled. Phrases are broadcast in blocks of about ``BLOCK_BYTES``
of benchmark text; a larger benchmark takes one pass per block and the spans
are merged by document.

Defined cases: null text has no words; null or empty items give no phrase; a
null item id is listed as an empty string; items that repeat an id count
once. Rows that repeat an id and text each get the full result. Documents of
any length are indexed in overlapping pieces. Empty tables give an empty
result, an empty benchmark gives no hit. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (ALNUM, U64, ascii_lower, cut, key_text, merge_spans, prefix_hash, ranges, restore_id, runs,
                     span_hash, utf8, word_pieces, word_spans, LOWER)

WINDOW = 13
BLOCK_BYTES = 4 << 20
SAMPLE = 16


# ------------------------------------------------------------ phrases

class Phrases:
    """Alphabet and distinct phrases of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        words = sorted({w for _, ws in items for w in ws})
        data = np.frombuffer(b"".join(words), np.uint8)
        end = np.cumsum([len(w) for w in words], dtype=np.int64)
        start = end - np.array([len(w) for w in words], np.int64)
        h = span_hash(prefix_hash(data), start, end) if words else np.zeros(0, U64)
        order = np.argsort(h)
        self.hashes = h[order]
        self.words = [words[i] for i in order]
        code = {w: i + 1 for i, w in enumerate(self.words)}          # 0 separates
        owners: dict[tuple[int, ...], set[int]] = {}
        self.items = sorted({i for i, _ in items})
        rank = {i: k for k, i in enumerate(self.items)}
        for item, ws in items:
            s = tuple(code[w] for w in ws)
            for a in range(max(1, len(s) - window + 1) if s else 0):
                owners.setdefault(s[a:a + window], set()).add(rank[item])
        self.length = np.array([len(p) for p in owners], np.int64)
        self.symbols = np.zeros((len(owners), window), np.int64)      # right-aligned
        for k, p in enumerate(owners):
            self.symbols[k, window - len(p):] = p
        self.owner_count = np.array([len(o) for o in owners.values()], np.int64)
        self.owners = np.array([i for o in owners.values() for i in sorted(o)], np.int64)
        self.owner_at = np.cumsum(self.owner_count) - self.owner_count

    def encode(self, h: np.ndarray) -> np.ndarray:
        """Symbols of word hashes; 0 for words in no phrase."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == h, at + 1, 0)


# ------------------------------------------------------------ index

def suffix_array(s: np.ndarray, bits: int) -> np.ndarray:
    """Suffix order of ``s``, in which every 0 is a symbol of its own, smaller
    than all others and ordered by position."""
    n = len(s)
    h = max(1, 62 // bits)
    key, alive = np.zeros(n, U64), np.ones(n, bool)
    for k in range(h):                                # the first h symbols, blank after a separator
        sym = np.zeros(n, np.int64)
        sym[:max(0, n - k)] = s[k:]
        alive &= sym > 0
        key = (key << U64(bits)) | np.where(alive, sym, 0).astype(U64)
    sa = np.argsort(key, kind="stable")
    k = key[sa]
    begin, end = runs(k)
    rank = np.empty(n, np.int64)
    rank[sa] = np.repeat(begin, end - begin)
    # a suffix that met its separator is in its place: ties go by position
    done = ~alive
    rank[sa[done[sa]]] = np.flatnonzero(done[sa])
    todo = sa[np.repeat(end - begin > 1, end - begin) & ~done[sa]]
    while len(todo):
        after = np.where(todo + h < n, rank[np.minimum(todo + h, n - 1)], -1) + 1
        order = np.argsort((rank[todo].astype(U64) << U64(32)) | after.astype(U64), kind="stable")
        todo, after = todo[order], after[order]
        old = rank[todo]
        begin, end = runs(old)
        place = np.repeat(old[begin], end - begin) + (np.arange(len(todo)) - np.repeat(begin, end - begin))
        sa[place] = todo
        begin, end = runs((old.astype(U64) << U64(32)) | after.astype(U64))
        rank[todo] = np.repeat(place[begin], end - begin)
        todo = todo[np.repeat(end - begin > 1, end - begin)]
        h *= 2
    return sa


class FMIndex:
    """FM-index of a symbol sequence that starts and ends with a separator."""

    def __init__(self, s: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma).bit_length())
        sa = suffix_array(s, self.bits)
        self.n = len(s)
        self.bwt = s[sa - 1]                                           # the sequence is read as a circle
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=sigma + 1))])
        # positions are sampled every SAMPLE symbols and after every separator
        at = np.arange(self.n)
        sampled = (at % SAMPLE == 0) | (s == 0)
        sampled[1:] |= s[:-1] == 0
        self.marked = sampled[sa]
        self.mark_rank = np.cumsum(self.marked) - 1
        self.samples = sa[self.marked]
        # wavelet tree: one level per bit, zeros before ones; ranks are running counts
        self.ones, self.zeros, level = [], [], self.bwt
        for b in range(self.bits - 1, -1, -1):
            bit = (level >> b) & 1
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.n - int(ones[-1]))
            bit = bit.astype(bool)
            level = np.concatenate([level[~bit], level[bit]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of c in bwt[:i], for arrays of symbols and positions."""
        base = np.zeros_like(i)
        for b, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            bit = ((c >> b) & 1).astype(bool)
            ri, rb = ones[i], ones[base]
            i = np.where(bit, zeros + ri, i - ri)
            base = np.where(bit, zeros + rb, base - rb)
        return i - base

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first row, end row) of the phrases that occur."""
        who = np.arange(len(phrases.length))
        lo, hi = np.zeros(len(who), np.int64), np.full(len(who), self.n, np.int64)
        for k in range(1, phrases.symbols.shape[1] + 1):
            live = phrases.length[who] >= k
            c = phrases.symbols[who, -k]
            a = np.where(live, self.first[c] + self.rank(c, lo), lo)
            b = np.where(live, self.first[c] + self.rank(c, hi), hi)
            some = a < b
            who, lo, hi = who[some], a[some], b[some]
            if not len(who):
                break
        return who, lo, hi

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions of suffix rows: back by LF to a sampled one."""
        steps, out, left = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64), np.arange(len(row))
        while len(left):
            hit = self.marked[row]
            out[left[hit]] = self.samples[self.mark_rank[row[hit]]] + steps[left[hit]]
            left, row = left[~hit], row[~hit]
            steps[left] += 1
            c = self.bwt[row]
            row = self.first[c] + self.rank(c, row)
        return out


def shard_hits(ph: Phrases, d, starts, ends, rows):
    """(phrase, first word) of the confirmed occurrences in one shard."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(starts) or not len(ph.length):
        return none
    lowered = LOWER[d]
    sym = ph.encode(span_hash(prefix_hash(lowered), starts, ends))
    # runs of words in no phrase, and document ends, become one separator each
    new_row = np.r_[False, rows[1:] != rows[:-1]]
    keep = sym > 0
    if not keep.any():
        return none
    at = np.flatnonzero(keep)
    gap = np.r_[True, (at[1:] - at[:-1] > 1) | new_row[at[1:]]]
    place = np.arange(len(at)) + np.cumsum(gap)
    s = np.zeros(place[-1] + 2, np.int64)
    s[place] = sym[at]
    word = np.zeros(len(s), np.int64)
    word[place] = at
    index = FMIndex(s, len(ph.hashes))
    who, lo, hi = index.search(ph)
    if not len(who):
        return none
    phrase, first = np.repeat(who, hi - lo), word[index.locate(ranges(lo, hi - lo))]
    # confirm on bytes, each word of an occurrence once
    seen = np.unique(ranges(first, ph.length[phrase]))
    right = np.zeros(len(starts) + 1, np.int64)
    right[seen] = [lowered[starts[i]:ends[i]].tobytes() != ph.words[sym[i] - 1] for i in seen]
    wrong = np.r_[0, np.cumsum(right)]
    ok = wrong[first + ph.length[phrase]] == wrong[first]
    return phrase[ok], first[ok]


OUT = "doc_id long, text_key long, n_words long, starts array<long>, ends array<long>, items array<string>"


def scan_task(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ph: Phrases = shared.value
        names = np.array(ph.items + [""], object)
        for b in batches:
            n = b.num_rows
            data, off = utf8(b.column("text"))
            n_words = np.zeros(n, np.int64)
            found = []                                     # row, start word, end word, phrase
            for i, d, o, starts, ends, rows, first, _ in word_pieces(data, off, ALNUM, WINDOW - 1):
                count = np.bincount(rows, minlength=len(o) - 1)
                n_words[i:i + len(o) - 1] = first + count
                phrase, word = shard_hits(ph, d, starts, ends, rows)
                if len(word):
                    in_row = word - (np.cumsum(count) - count)[rows[word]] + first
                    found.append((rows[word] + i, in_row, in_row + ph.length[phrase], phrase))
            row, s, e, p = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
            k = ph.owner_count[p] if len(p) else p
            pairs = np.unique(np.stack([np.repeat(row, k), ph.owners[ranges(ph.owner_at[p], k)]], 1), axis=0) if len(p) else np.zeros((0, 2), np.int64)
            row, s, e = merge_spans(row, s, e)
            at = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
            of = np.searchsorted(pairs[:, 0], np.arange(n + 1)).astype(np.int32)
            lists = lambda cuts, v: pa.ListArray.from_arrays(pa.array(cuts), v)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(n_words), lists(at, pa.array(s)), lists(at, pa.array(e)),
                 lists(of, pa.array(names[pairs[:, 1]].tolist(), pa.string()))], names=[x.split()[0] for x in OUT.split(", ")])
    return task


def item_words(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"),
                            ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"))


def find_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: (doc_id, text_key, n_words, removal spans as
    ``starts`` and ``ends`` in words, end exclusive, and the ``items`` that occur)."""
    spark = docs.sparkSession
    items = item_words(benchmark, item_col, item_text)
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0) // block_bytes))
    keyed = key_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    each = []
    for k in range(blocks):
        # a block is bounded by block_bytes on average; phrases of other blocks never meet in memory
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        words = [(r.item_id, split_words(r.text.encode())) for r in part]
        shared = spark.sparkContext.broadcast(Phrases(words))
        each.append(keyed.mapInArrow(scan_task(shared), OUT))
    if blocks == 1:
        return each[0]
    base = cut(each[0], "decontaminate-block")
    rest = reduce(DataFrame.unionByName, [cut(x, "decontaminate-block").where(F.size("starts") > 0) for x in each[1:]])
    rest = rest.dropDuplicates().groupBy("doc_id", "text_key").agg(
        *[F.flatten(F.collect_list(c)).alias(f"more_{c}") for c in ("starts", "ends", "items")])

    def merged(batches):
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                s, e = r["starts"] + (r.pop("more_starts") or []), r["ends"] + (r.pop("more_ends") or [])
                _, s, e = merge_spans(np.zeros(len(s), np.int64), np.array(s, np.int64), np.array(e, np.int64))
                r |= {"starts": s.tolist(), "ends": e.tolist(), "items": sorted(set(r["items"] + (r.pop("more_items") or [])))}
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [b.schema.field(c) for c in [x.split()[0] for x in OUT.split(", ")]]))

    return base.join(rest, ["doc_id", "text_key"], "left").mapInArrow(merged, OUT)


def split_words(text: bytes) -> list[bytes]:
    d = np.frombuffer(text, np.uint8)
    s, e, _ = word_spans(d, np.array([0, len(d)], np.int64), ALNUM)
    low = LOWER[d]
    return [low[a:b].tobytes() for a, b in zip(s, e)]


def report(spans: DataFrame) -> DataFrame:
    """The spans' counts and the contamination rule: at least one word in 20."""
    hit = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return spans.select(
        restore_id(), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((hit > 0) & (hit * 20 >= F.col("n_words"))).alias("contaminated"))


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    spans = find_spans(docs, benchmark)
    n = spans.withColumn("_hit", F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"),
                                             lambda a, x: a + x))
    bad = n.where((F.col("_hit") > 0) & (F.col("_hit") * 20 >= F.col("n_words"))).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    bad = cut(bad, "contaminated")
    keyed = docs.withColumns({"_id": F.coalesce(F.col("doc_id"), F.lit(-2 ** 63)),
                              "_key": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    return keyed.join(bad, ["_id", "_key"], "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(find_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                             spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS n,
             array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS phrase
      FROM b, unnest(range(1, greatest(1, len(w) - {WINDOW} + 1) + 1)) AS r(i) WHERE len(w) > 0),
n AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
      FROM d, n, unnest(range(1, len(w) - n + 2)) AS r(i) WHERE len(w) >= n),
h AS (SELECT g.doc_id, g.i, g.n, p.item_id FROM g JOIN p USING (n, phrase)),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM h, unnest(range(i, i + n)) AS r(j) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
