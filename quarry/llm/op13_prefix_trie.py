"""Prefix trie of conversations in minimal-perfect-hash node tables.

Conversations that start with the same turns share nodes; per node the trie
says how many conversations pass, how many leaves lie below and how many words
need not be repeated. Steps:

1. prefix digests: turns are range-sorted by (conversation, turn) and every
   partition adds up its turns' digests as a polynomial (two lanes of 64 bits,
   over bits of SHA-256). Sums of neighbouring partitions combine, so one
   conversation may fill many partitions. A conversation that takes its first
   turns from another one gets its prefixes by shifting these sums.
2. shards: (conversation family, stretch of ``SEGMENT`` depths) are dealt to
   shards of about ``SHARD_ROWS`` rows. A shard enumerates its distinct prefix
   digests, builds a minimal perfect hash over them, confirms the 128-bit
   digest and depth in each slot, and scatters its counts into flat arrays by
   slot. The same node in several shards (a hot first turn is in all of them)
   is added up by digest: one row per shard, whatever the number of copies.
3. a node belongs to the shard of its smallest member. Every shard gets the
   totals of its nodes back and accumulates, deepest first, through its
   parent-slot array; only owned nodes have a value, so adding up the shards
   counts every node once. What lies in deeper stretches of a long
   conversation comes as a carry per (conversation, stretch).
4. ends: the ids that end at a node are sorted by range and joined to pieces of
   text of bounded size, which one state per node hashes in order: SHA-256
   cannot be taken in parts, but only the text goes through it.

Defined cases: rows without a conversation id are no conversation and are left
out. Turns are ordered by turn, null first; equal turns by the SHA-256 of
role and text, so the row order does not matter and repeated rows are turns of
their own. Null role or text is ''. A conversation without rebuilt turns is a
member of the root alone. An empty table has no nodes. Extra columns are
ignored. Families: ``conv_id - conv_id % family`` (remainders of negative
numbers as in SQL).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, cut, hot_join, mix, n_buckets, runs

SEGMENT = 4096                   # depths of a conversation that stay together
SHARD_ROWS = 250_000             # prefix rows of a shard
CHUNK = 1 << 16                  # bytes of id text hashed at once
LANES = (U64(0x9E3779B97F4A7C15), U64(0xD1342543DE82EF95))
WORDS = r"[^\x20\x09-\x0D]+"


# ------------------------------------------------------------ minimal perfect hash

class NodeTable:
    """Slots 0..n-1 for n distinct (lane 1, lane 2, depth) keys.

    Levels of cells: a key alone in its cell stays there, the others go on to
    the next level; the slot is the rank of the cell among all taken ones. A
    lookup compares the whole key with the one in the slot."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        todo, done = np.arange(len(x)), 0
        slot = np.empty(len(x), np.int64)
        while len(todo):
            size = 2 * len(todo)
            cell = self.cell(len(self.levels), size, x[todo], y[todo], depth[todo])
            alone = np.bincount(cell, minlength=size) == 1
            rank = np.cumsum(alone) - 1 + done
            slot[todo[alone[cell]]] = rank[cell[alone[cell]]]
            self.levels.append((size, np.where(alone, rank, -1), done))
            done += int(alone.sum())
            todo = todo[~alone[cell]]
        self.x, self.y, self.depth = (np.empty_like(a) for a in (x, y, depth))
        self.x[slot], self.y[slot], self.depth[slot] = x, y, depth

    @staticmethod
    def cell(level: int, size: int, x, y, depth) -> np.ndarray:
        h = mix(mix(x + U64(level)) ^ (y + depth.astype(U64) * LANES[0]))
        return (h % U64(size)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.x)

    def slots(self, x: np.ndarray, y: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for a key that is not in the table."""
        out = np.full(len(x), -1, np.int64)
        todo = np.arange(len(x))
        for level, (size, rank, _) in enumerate(self.levels):
            at = rank[self.cell(level, size, x[todo], y[todo], depth[todo])]
            out[todo[at >= 0]] = at[at >= 0]
            todo = todo[at < 0]
        found = np.flatnonzero(out >= 0)
        at = out[found]
        same = (self.x[at] == x[found]) & (self.y[at] == y[found]) & (self.depth[at] == depth[found])
        out[found[~same]] = -1
        return out


def distinct_keys(x, y, depth) -> np.ndarray:
    """One row number per distinct key."""
    order = np.lexsort((y, x, depth))
    new = np.r_[True, (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0) | (np.diff(depth[order]) != 0)]
    return order[new]


# ------------------------------------------------------------ prefix digests

def lanes(digests: pa.Array) -> np.ndarray:
    """(2, n) words of a column of 16-byte digests."""
    off = np.frombuffer(digests.buffers()[1], np.int32)[digests.offset:digests.offset + len(digests) + 1]
    data = np.frombuffer(digests.buffers()[2], np.uint8)[off[0]:off[-1]] if len(digests) else np.zeros(0, np.uint8)
    return np.ascontiguousarray(data).view(U64).reshape(-1, 2).T


def power(i: np.ndarray, lane: int, inverse: bool = False) -> np.ndarray:
    base = U64(pow(int(LANES[lane]), -1, 1 << 64)) if inverse else LANES[lane]
    return np.power(base, i.astype(U64))


RANKED = "conv_id long, part long, q long, s1 long, s2 long, t1 long, t2 long, words long"


def ranking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rank and running digest of every turn inside its conversation and partition."""
    part = TaskContext.get().partitionId()
    conv, rank, total = None, 0, [0, 0]
    for b in batches:
        if not b.num_rows:
            continue
        c = b.column("conv_id").to_numpy()
        begin, end = runs(c)
        goes_on = conv is not None and c[0] == conv
        q = np.arange(len(c)) - np.repeat(begin, end - begin) + 1
        q[:end[0]] += rank if goes_on else 0
        t = lanes(b.column("digest"))
        s = np.zeros_like(t)
        for k in (0, 1):
            run = np.cumsum(t[k] * power(q, k), dtype=U64)
            before = np.where(begin > 0, run[begin - 1], U64(0))
            before[0] = U64(0) - U64(total[k]) if goes_on else U64(0)
            s[k] = run - np.repeat(before, end - begin)
        conv, rank, total = c[-1], int(q[-1]), [int(s[0][-1]), int(s[1][-1])]
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), pa.array(np.full(len(c), part)), pa.array(q), *(pa.array(np.ascontiguousarray(a).view(np.int64))
             for a in (*s, *t)), b.column("words")], names=[x.split()[0] for x in RANKED.split(", ")])


def ranked_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, p, s1, s2, t1, t2, words) of every turn and (conv_id, n):
    p counts a conversation's turns from 1, s is the digest of turns 1..p."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    narrow = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
        F.unhex(F.substring(F.sha2(F.concat(F.octet_length(text("role")).cast("string"), F.lit(":"), text("role"), text("text")), 256), 1, 32)).alias("digest"),
        F.regexp_count(text("text"), F.lit(WORDS)).cast("long").alias("words"))
    # texts are read once: finding the ranges and dealing the rows look at digests only
    narrow = cut(narrow, "trie-digests")
    parts = cut(narrow.repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest")
                .mapInArrow(ranking, RANKED), "trie-turns")
    convs = cut(parts.groupBy("conv_id").agg(F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high")), "trie-convs")
    # a border between two partitions cuts one conversation at most: two rows per partition
    torn = convs.where("low < high").select("conv_id")
    ends = (parts.join(F.broadcast(torn), "conv_id").groupBy("conv_id", "part")
            .agg(F.max_by(F.struct("q", "s1", "s2"), "q").alias("e")).orderBy("conv_id", "part").collect())
    before: dict[tuple[int, int], tuple[int, int, int]] = {}
    conv, rank, total = None, 0, [0, 0]
    for r in ends:
        if r.conv_id != conv:
            conv, rank, total = r.conv_id, 0, [0, 0]
        before[(conv, r.part)] = (rank, *total)
        for k, s in enumerate((r.e.s1, r.e.s2)):
            total[k] = (total[k] + s * pow(int(LANES[k]), rank, 1 << 64)) % (1 << 64)
        rank += r.e.q

    def shift(batches):
        for b in batches:
            c, part, q = (b.column(x).to_numpy() for x in ("conv_id", "part", "q"))
            s = [b.column(x).to_numpy().view(U64).copy() for x in ("s1", "s2")]
            p = q.copy()
            key = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (part[1:] != part[:-1])]) if len(c) else []
            for lo, hi in zip(key, [*key[1:], len(c)]):
                if (add := before.get((int(c[lo]), int(part[lo])))) is not None:
                    p[lo:hi] += add[0]
                    for k in (0, 1):
                        s[k][lo:hi] = s[k][lo:hi] * U64(pow(int(LANES[k]), add[0], 1 << 64)) + U64(add[1 + k])
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(p), *(pa.array(a.view(np.int64)) for a in s),
                                              b.column("t1"), b.column("t2"), b.column("words")],
                                             names=["conv_id", "p", "s1", "s2", "t1", "t2", "words"])

    return parts.mapInArrow(shift, "conv_id long, p long, s1 long, s2 long, t1 long, t2 long, words long"), convs.select("conv_id", "n")


# ------------------------------------------------------------ rebuilt conversations

PREFIX = "conv_id long, d long, x1 long, x2 long, p1 long, p2 long, words long, ends boolean"


def prefix_rows(ranked: DataFrame, convs: DataFrame, family: int, heads: int) -> DataFrame:
    """One row per conversation and rebuilt prefix, the empty one included:
    digest of the prefix, of the prefix before it, words of its last turn."""
    total = convs.agg(F.sum("n")).first()[0] or 0
    first = ranked.where(F.col("p") < heads).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("p", "s1", "s2", "t1", "t2", "words"))).alias("head"))
    base = F.col("conv_id") - F.col("conv_id") % family
    whole = convs.join(first, "conv_id", "left").withColumns({
        "base": base, "h": F.when(base == F.col("conv_id"), 0).otherwise(F.crc32(F.col("conv_id").cast("string")) % heads)})
    bases = whole.select(F.col("conv_id").alias("base"), F.col("n").alias("bn"), F.col("head").alias("bhead"))
    s = lambda head, i, lane: F.when(F.col(i) > 0, F.get(F.col(head), F.col(i).cast("int") - 1)[lane]).otherwise(F.lit(0).cast("long"))
    plan = whole.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("bn", F.lit(0)))).withColumn("cutoff", F.least("h", "n"))
    plan = cut(plan.select("conv_id", "n", "h", "shared", F.slice("bhead", F.lit(1), F.col("shared").cast("int")).alias("turns"),
                           s("bhead", "shared", "s1").alias("b1"), s("bhead", "shared", "s2").alias("b2"),
                           s("head", "cutoff", "s1").alias("c1"), s("head", "cutoff", "s2").alias("c2")), "trie-plan")
    m = F.col("shared") + F.greatest(F.lit(0), F.col("n") - F.col("h"))
    empty = F.struct(F.lit(0).cast("long").alias("p"), *[F.lit(0).cast("long").alias(c) for c in ("s1", "s2", "t1", "t2", "words")])
    taken = plan.select("conv_id", F.explode(F.concat(F.array(empty), F.coalesce("turns", F.array().cast("array<struct<p:long,s1:long,s2:long,t1:long,t2:long,words:long>>")))).alias("x"), m.alias("m")) \
        .select("conv_id", F.col("x.p").alias("d"), "x.s1", "x.s2", "x.t1", "x.t2", "x.words", "m")
    zero = F.lit(0).cast("long")
    taken = taken.select("*", zero.alias("b1"), zero.alias("b2"), zero.alias("c1"), zero.alias("c2"), zero.alias("move"))
    own = hot_join(ranked, plan.select("conv_id", "n", "h", "shared", "b1", "b2", "c1", "c2"), "conv_id", "n", total).where("p > h").select(
        "conv_id", (F.col("p") - F.col("h") + F.col("shared")).alias("d"), "s1", "s2", "t1", "t2", "words", m.alias("m"),
        "b1", "b2", "c1", "c2", (F.col("shared") - F.col("h")).alias("move"))

    def digests(batches):
        for b in batches:
            get = lambda c: b.column(c).to_numpy().view(U64)
            d, move = b.column("d").to_numpy(), b.column("move").to_numpy()
            out = []
            for k in (0, 1):
                by = np.where(move >= 0, power(np.maximum(move, 0), k), power(np.maximum(-move, 0), k, inverse=True))
                x = get(f"b{k + 1}") + (get(f"s{k + 1}") - get(f"c{k + 1}")) * by
                out.append((x, np.where(d > 0, x - get(f"t{k + 1}") * power(d, k), U64(0))))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("d"), *(pa.array(a.view(np.int64)) for a in (out[0][0], out[1][0], out[0][1], out[1][1])),
                 b.column("words"), pa.array(d == b.column("m").to_numpy())], names=[x.split()[0] for x in PREFIX.split(", ")])

    return taken.unionByName(own).mapInArrow(digests, PREFIX)


# ------------------------------------------------------------ shards

def column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().to_numpy(zero_copy_only=False)


LOCAL = "shard long, d long, x1 long, x2 long, p1 long, p2 long, words long, ghost boolean, first long, n long, n_end long"


def counting(t: pa.Table) -> pa.Table:
    """A shard's distinct nodes with their counts."""
    x, y = column(t, "x1").view(U64), column(t, "x2").view(U64)
    d, conv, ghost = column(t, "d"), column(t, "conv_id"), column(t, "ghost")
    # the last prefix of the stretch before is there as a parent only: a key of its own
    one = distinct_keys(x, y, 2 * d + ghost)
    nodes = NodeTable(x[one], y[one], (2 * d + ghost)[one])
    slot = nodes.slots(x, y, 2 * d + ghost)
    n = np.bincount(slot, minlength=len(nodes))
    n_end = np.bincount(slot, weights=column(t, "ends"), minlength=len(nodes)).astype(np.int64)
    first = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(first, slot, conv)
    rows = np.empty(len(nodes), np.int64)
    rows[slot[one]] = one
    pick = t.take(pa.array(rows)).select(["shard", "d", "x1", "x2", "p1", "p2", "words", "ghost"])
    for name, a in (("first", first), ("n", n), ("n_end", n_end)):
        pick = pick.append_column(name, pa.array(a))
    return pick


SUMMED = "d long, x1 long, x2 long, conv_id long, n_convs long, parent long, children long, leaves long, saved long"


def accumulating(t: pa.Table, segment: int) -> pa.Table:
    """A shard's part of each of its nodes' subtree sums."""
    x, y = column(t, "x1").view(U64), column(t, "x2").view(U64)
    d, ghost, words = column(t, "d"), column(t, "ghost"), column(t, "words")
    first, n, n_end = column(t, "conv_id"), column(t, "n_convs"), column(t, "n_ends")
    nodes = NodeTable(x, y, 2 * d + ghost)
    slot = nodes.slots(x, y, 2 * d + ghost)
    # the parent of a stretch's first depth is the kept last prefix of the one before
    up = nodes.slots(column(t, "p1").view(U64), column(t, "p2").view(U64), 2 * (d - 1) + (d % segment == 0))
    up[ghost | (d == 0)] = -1
    row = np.empty(len(x), np.int64)
    row[slot] = np.arange(len(x))
    parent = np.full(len(x), -1)
    parent[slot] = up
    mine = (column(t, "first") == first) & ~ghost
    leaves, saved, children = (np.zeros(len(x), np.int64) for _ in range(3))
    leaves[slot] = mine * (n == n_end) + column(t, "carry_leaves")
    saved[slot] = mine * (n - 1) * words + column(t, "carry_saved")
    has = np.flatnonzero(mine & (up >= 0))
    np.add.at(children, up[has], 1)
    depth = d[row]
    order = np.argsort(-depth, kind="stable")
    order = order[parent[order] >= 0]
    for lo, hi in zip(*runs(depth[order])):                       # deepest first
        at = order[lo:hi]
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])
    quiet = ghost                                                  # carries bring these sums
    parent_conv = pa.array(np.where(up >= 0, first[row[up]], 0), mask=~(mine & (up >= 0)))
    return pa.Table.from_arrays(
        [t.column("d"), t.column("x1"), t.column("x2"), pa.array(first), pa.array(n), parent_conv, pa.array(children[slot]),
         pa.array(np.where(quiet, 0, leaves[slot])), pa.array(np.where(quiet, 0, saved[slot]))],
        names=[c.split()[0] for c in SUMMED.split(", ")])


def carries(prefixes: DataFrame, nodes: DataFrame, segment: int) -> DataFrame:
    """(shard, d, x1, x2, carry_leaves, carry_saved): what a long conversation
    owns in the stretches after each of its stretches, at the last prefix of that one."""
    seg = F.floor(F.col("d") / segment).cast("long")
    last = prefixes.where(~F.col("ghost") & ((F.col("d") + 1) % segment == 0)).select(
        "conv_id", seg.alias("seg"), "shard", "d", "x1", "x2")
    owned = nodes.select(F.col("conv_id"), seg.alias("seg"), (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaf"),
                         ((F.col("n_convs") - 1) * F.col("words")).alias("save"))
    owned = owned.join(last.select("conv_id").distinct(), "conv_id", "left_semi").groupBy("conv_id", "seg").agg(
        F.sum("leaf").alias("leaf"), F.sum("save").alias("save"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    both = last.join(owned, ["conv_id", "seg"], "full").select("*", F.sum("leaf").over(after).alias("l"), F.sum("save").over(after).alias("s"))
    return both.where("shard is not null").groupBy("shard", "d", "x1", "x2").agg(
        F.coalesce(F.sum("l"), F.lit(0)).cast("long").alias("carry_leaves"), F.coalesce(F.sum("s"), F.lit(0)).cast("long").alias("carry_saved"))


# ------------------------------------------------------------ ends

def ends_digests(prefixes: DataFrame) -> DataFrame:
    """(d, x1, x2, ends_sha256) of the nodes where conversations end."""
    key = ["d", "x1", "x2"]

    def joining(batches):
        here, parts, size, number = None, [], 0, 0
        part = TaskContext.get().partitionId()
        for b in batches:
            out = []
            k = np.stack([b.column(c).to_numpy() for c in key], 1)
            conv = b.column("conv_id").to_numpy()
            cuts = np.r_[0, np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1, len(k)] if len(k) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                now = tuple(k[lo].tolist())
                if now != here:
                    if parts:
                        out.append((*here, part, number, ",".join(parts)))
                    here, parts, size, number = now, [], 0, 0
                for at in range(lo, hi, CHUNK // 8):
                    text = ",".join(map(str, conv[at:min(hi, at + CHUNK // 8)].tolist()))
                    parts.append(text)
                    size += len(text)
                    if size >= CHUNK:
                        out.append((*here, part, number, ",".join(parts)))
                        parts, size, number = [], 0, number + 1
            yield as_rows(out)
        if parts:
            yield as_rows([(*here, part, number, ",".join(parts))])

    def as_rows(out):
        cols = list(zip(*out)) or [()] * 6
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.string())],
                                          names=[*key, "part", "number", "ids"])

    def hashing(batches):
        here, state = None, None
        for b in batches:
            done = []
            for *now, ids in zip(*(b.column(c).to_pylist() for c in (*key, "ids"))):
                if now != here:
                    if here:
                        done.append((*here, state.hexdigest()))
                    here, state = now, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield as_digests(done)
        if here:
            yield as_digests([(*here, state.hexdigest())])

    def as_digests(done):
        cols = list(zip(*done)) or [()] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                          names=[*key, "ends_sha256"])

    rows = prefixes.where("ends AND NOT ghost").select(*key, "conv_id")
    pieces = (rows.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
              .mapInArrow(joining, "d long, x1 long, x2 long, part long, number long, ids string"))
    return (pieces.repartition(*key).sortWithinPartitions(*key, "part", "number")
            .mapInArrow(hashing, "d long, x1 long, x2 long, ends_sha256 string"))


# ------------------------------------------------------------ operator

def prefix_trie(turns: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations of ``turns`` (conv_id,
    turn, role, text): the first crc32(id) % ``heads`` turns come from the
    first conversation of the family. ``heads=1`` takes them as they are."""
    spark, segment = turns.sparkSession, SEGMENT
    key = ["d", "x1", "x2"]
    ranked, convs = ranked_turns(turns)
    rows = cut(prefix_rows(ranked, convs, family, heads), "trie-prefixes")
    size = rows.agg(F.count("*"), F.max("d")).first()
    shards, deep = n_buckets(spark, size[0], SHARD_ROWS), (size[1] or 0) >= segment
    seg = F.floor(F.col("d") / segment).cast("long")
    # the last prefix of a stretch is also there, as a parent, for the next one
    places = F.when((F.col("d") + 1) % segment == 0, F.array(F.struct(seg.alias("seg"), F.lit(False).alias("ghost")),
                                                             F.struct((seg + 1).alias("seg"), F.lit(True).alias("ghost")))
                    ).otherwise(F.array(F.struct(seg.alias("seg"), F.lit(False).alias("ghost"))))
    dealt = rows.select("*", F.explode(places).alias("at")).select(
        "conv_id", "d", "x1", "x2", "p1", "p2", "words", "ends", "at.ghost",
        F.pmod(F.xxhash64(F.col("conv_id") - F.col("conv_id") % family, "at.seg"), F.lit(shards)).alias("shard"))
    local = cut(dealt.groupBy("shard").applyInArrow(counting, LOCAL), "trie-local")
    nodes = local.where("NOT ghost").groupBy(*key).agg(
        F.min("first").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("n_end").alias("n_ends"), F.max("words").alias("words"))
    if deep:
        nodes = cut(nodes, "trie-nodes")
    whole = local.join(nodes.drop("words"), key)
    if deep:
        whole = whole.join(carries(dealt, nodes, segment), ["shard", *key], "left")
        whole = whole.withColumns({c: F.when(F.col("ghost"), 0).otherwise(F.coalesce(c, F.lit(0))).cast("long") for c in ("carry_leaves", "carry_saved")})
    else:
        whole = whole.withColumns({c: F.lit(0).cast("long") for c in ("carry_leaves", "carry_saved")})
    sums = whole.groupBy("shard").applyInArrow(lambda t: accumulating(t, segment), SUMMED).groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.max("parent").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"),
        F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    none = hashlib.sha256(b"").hexdigest()
    return sums.join(ends_digests(dealt), key, "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS p
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, conv_id::VARCHAR AS s,
    list({'role': role, 'text': text} ORDER BY p) AS own FROM t GROUP BY conv_id),
k AS (SELECT *, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
        list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::UBIGINT)), lambda a, ch:
        list_reduce(list_prepend(xor(a, ch), [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]),
            lambda x, j: xor(x >> 1, (x & 1) * 3988292384)))) % 4 AS h FROM c),
b AS (SELECT k.conv_id, coalesce(f.own[1:k.h], []) || k.own[k.h + 1:] AS turns FROM k LEFT JOIN k f ON f.conv_id = k.base),
m AS (SELECT conv_id, d, turns[1:d] AS node, d = len(turns) AS ends,
        CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
    FROM b, unnest(range(0, len(turns) + 1)) AS r(d)),
n AS (SELECT node, min(conv_id) AS conv_id, d, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256,
        bool_and(ends) AS leaf FROM m GROUP BY node, d),
u AS (SELECT m.node, m.d, sum(n.leaf::BIGINT) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens,
        count(*) FILTER (n.d = m.d + 1) AS n_children
    FROM n JOIN m ON m.conv_id = n.conv_id AND m.d <= n.d GROUP BY m.node, m.d)
SELECT n.conv_id, n.d AS depth, f.conv_id AS parent_conv_id, n.n_convs, u.n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
    CAST(u.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN u ON u.node = n.node AND u.d = n.d LEFT JOIN n f ON f.d = n.d - 1 AND f.node = n.node[1:n.d - 1]
"""
