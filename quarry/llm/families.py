"""From posting lists to exact links between sets, without writing out pairs.

Candidate search gives posting lists, (key, cid), in which every pair of
similar sets meets at least once, and a fixed-width ``payload`` per set on
which ``agree`` decides whether two sets may be similar. Then:

1. star: in every list the smallest id leads; each set takes the leader that
   it meets most often, if the payloads agree: one pair per set;
2. lists: sets joined by such pairs are a family. Lists that hold several
   families are compared in blocks, and what is written are the links that
   join two families, fewer than the list has families. Families widen by them
   and the members outside a long list's largest family go past its other
   blocks: afterwards any two sets that meet and agree are of one family,
   and a group of mutual near misses costs links in proportion to its lists;
3. decision: every set of a family asks its star leader on the full sets; all
   other pairs of a family are decided on the full sets, each pair of blocks
   once, but for pairs that are joined already. Again only links that join
   something are written.

Blocks of lists are bounded by members, blocks of full sets by bytes, too. The
number of rows written is linear in the number of list entries; the comparing
work is quadratic only in the part of a list or family that nothing joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, cut, utf8
from .components import components

BLOCK = 2048                     # members of a list or family that meet in one task
BLOCK_BYTES = 16 << 20           # bytes of full sets of a block
QUERIES = 4096                   # sets that ask one leader in one task
Agree = Callable[[np.ndarray, np.ndarray], np.ndarray]


def payloads(col) -> np.ndarray:
    """(n, width) bytes of a column of equally long values."""
    data, off = utf8(col)
    return data.reshape(len(off) - 1, -1) if len(data) else np.zeros((len(off) - 1, 0), np.uint8)


class Joined:
    """Which labels are known to be linked, inside one task."""

    def __init__(self):
        self.boss: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.boss.setdefault(x, x)) != x:
            self.boss[x] = x = self.boss.setdefault(up, up)
        return x

    def join(self, x: int, y: int) -> bool:
        """True if this links something new."""
        x, y = self.root(x), self.root(y)
        self.boss[max(x, y)] = min(x, y)
        return x != y


# ------------------------------------------------------------ star

def star_pairs(posted: DataFrame, sketches: DataFrame, agree: Agree) -> DataFrame:
    """(q, comp): each set with the leader that it meets most often, if the payloads agree."""
    leads = posted.groupBy("key").agg(F.min("cid").alias("lead"))
    met = (posted.join(leads, "key").where("cid <> lead").groupBy("cid", "lead").agg(F.count("*").alias("n"))
           .groupBy("cid").agg(F.max(F.struct(F.col("n"), F.bitwise_not("lead").alias("first"))).alias("m"))
           .select("cid", F.bitwise_not("m.first").alias("lead")))

    def check(batches):
        for b in batches:
            ok = pa.array(agree(payloads(b.column("payload")), payloads(b.column("other"))))
            yield pa.RecordBatch.from_arrays([b.column(c).filter(ok) for c in ("cid", "lead")], names=["q", "comp"])

    return (met.join(sketches, "cid").join(sketches.select(F.col("cid").alias("lead"), F.col("payload").alias("other")), "lead")
            .select("cid", "lead", "payload", "other").mapInArrow(check, "q long, comp long"))


# ------------------------------------------------------------ lists

def list_links(posted: DataFrame, sketches: DataFrame, labels: DataFrame, agree: Agree, visits: bool) -> DataFrame:
    """(a, b): links between families (``labels``: cid, family) of which members
    meet in a list and agree, a spanning set of them per block. A block's own
    members meet first; with ``visits``, members of different blocks of the
    lists that still hold several families."""
    block = BLOCK
    rows = posted.join(labels, "cid", "left").select("key", "cid", F.coalesce("family", "cid").alias("family"))
    per = rows.groupBy("key", "family").agg(F.count("*").alias("n"))
    lists = per.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("families"), F.max_by("family", F.struct("n", "family")).alias("major"))
    nb = F.ceil(F.col("n") / block).cast("int")
    lists = lists.where((F.col("families") > 1) & ((nb > 1) if visits else F.lit(True)))
    own = F.pmod(F.xxhash64("cid"), nb).cast("int")
    at = F.array(F.struct(own.alias("block"), F.lit(0).alias("role")))
    if visits:
        others = F.filter(F.sequence(F.lit(0), nb - 1), lambda k: k != own)
        at = F.concat(at, F.when(F.col("family") != F.col("major"), F.transform(others, lambda k: F.struct(k.alias("block"), F.lit(1).alias("role"))))
                      .otherwise(F.array().cast("array<struct<block:int,role:int>>")))
    dealt = (rows.join(lists, "key").select("key", "cid", "family", F.explode(at).alias("v"))
             .join(sketches, "cid").select("key", "v.block", "v.role", "family", "payload"))

    def match(batches):
        for a, b in linked_groups(batches, agree, visits):
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return (dealt.repartition("key", "block").sortWithinPartitions("key", "block", "role")
            .mapInArrow(match, "a long, b long").distinct())


def linked_groups(batches: Iterator[pa.RecordBatch], agree: Agree, visits: bool) -> Iterator[tuple[list[int], list[int]]]:
    """Links of a stream sorted by list block and role. Members of a block
    (role 0) are held; visitors (role 1) pass by."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        get = lambda c: b.column(c).to_numpy()
        x = {"g": np.stack([get("key"), get("block").astype(np.int64)], 1), "role": get("role"), "family": get("family"),
             "payload": payloads(b.column("payload"))}
        if held is not None:                                  # the last block of the batch before goes on
            x = {k: np.concatenate([held[k], v]) for k, v in x.items()}
        seen = 0 if held is None else len(held["family"])
        yield link_blocks(x, seen, agree, visits)
        same = (x["g"] == x["g"][-1]).all(1)
        held = {k: v[same & (x["role"] == 0)] for k, v in x.items()}


def link_blocks(x: dict, seen: int, agree: Agree, visits: bool) -> tuple[list[int], list[int]]:
    """Links between families of one block whose members agree, a spanning set
    per block; at least one of the two stands after the first ``seen`` rows.
    Families of ``x`` become those joined here."""
    n = len(x["family"])
    new = np.r_[True, (x["g"][1:] != x["g"][:-1]).any(1)]
    size = np.diff(np.r_[np.flatnonzero(new), n])
    group = np.cumsum(new) - 1
    # a node per block and family; its root is the joined family
    order = np.lexsort((x["family"], group))
    first = np.r_[True, (np.diff(group[order]) != 0) | (np.diff(x["family"][order]) != 0)]
    node = np.empty(n, np.int64)
    node[order] = np.cumsum(first) - 1
    name = x["family"][order][first]
    root = np.arange(len(name))
    joined, out = Joined(), ([], [])
    for d in range(1, int(size.max())):
        i = np.flatnonzero((group[:-d] == group[d:]) & (x["role"][:-d] == 0) & ((x["role"][d:] == 1) if visits else True)
                           & (root[node[:-d]] != root[node[d:]]))
        i = i[i + d >= seen]
        change = False
        for k in range(0, len(i), 8192):
            a = i[k:k + 8192]
            a = a[agree(x["payload"][a], x["payload"][a + d])]
            for p, q in zip(node[a].tolist(), node[a + d].tolist()):
                if joined.join(p, q):
                    out[0].append(int(name[p]))
                    out[1].append(int(name[q]))
                    change = True
        if change:
            for p in joined.boss:
                root[p] = joined.root(p)
    x["family"] = name[root][node]
    return out


def widen(posted: DataFrame, sketches: DataFrame, pairs: DataFrame, agree: Agree) -> DataFrame:
    """(cid, family) of every set that may be similar to another one."""
    def labelled(links):
        return components(links).select(F.col("id").alias("cid"), F.col("comp").alias("family"))

    links = pairs.select(F.col("q").alias("a"), F.col("comp").alias("b"))
    families = labelled(links)
    for visits in (False, True):
        # family labels are ids of sets, so these links join the earlier ones
        links = cut(links.unionByName(list_links(posted, sketches, families, agree, visits)), "family-links")
        families = labelled(links)
    return families


# ------------------------------------------------------------ decision on full sets

class Block:
    """The sets of a block's members, as places in one list of elements."""

    def __init__(self, sets: list[np.ndarray], ids: list[int], labels: list[int]):
        self.size = np.array([len(x) for x in sets], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.elements, self.place = np.unique(np.concatenate(sets), return_inverse=True)
        self.ids, self.labels = np.array(ids), np.array(labels)
        self.mark = np.zeros(len(self.elements), bool)

    def similar(self, g: np.ndarray, cid: int, label: int, num: int, den: int) -> np.ndarray:
        """Labels of the members of other labels with den * shared >= num * union."""
        n = self.size
        ok = (n * den >= num * len(g)) & (len(g) * den >= num * n) & (self.ids != cid) & (self.labels != label)
        if not ok.any():                           # all joined already, or too unlike in size
            return self.labels[:0]
        at = np.searchsorted(self.elements, g)
        at = at[at < len(self.elements)]
        at = at[self.elements[at] == g[:len(at)]]
        self.mark[at] = True
        shared = np.add.reduceat(self.mark[self.place], self.at, dtype=np.int64)
        self.mark[at] = False
        return np.unique(self.labels[ok & (den * shared >= num * (n + len(g) - shared))])


def meetings(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between labels. ``rows``: (unit, held, lot, role, cid, label);
    the members (role 0) of a meeting (unit, held, lot) are asked by its
    visitors (role 1); links that others of the task imply are left out."""
    def check(batches):
        here, who, labels, have, block, joined = None, [], [], [], None, Joined()
        for b in batches:
            out: list[tuple[int, int]] = []
            keys = zip(*(b.column(c).to_pylist() for c in ("unit", "held", "lot", "role", "cid", "label")))
            data, off = utf8(b.column("set"))
            for r, (*now, role, cid, label) in enumerate(keys):
                if now != here:
                    here, who, labels, have, block, joined = now, [], [], [], None, Joined()
                g = np.frombuffer(data[off[r]:off[r + 1]].tobytes(), U64)
                if role == 0:
                    who.append(cid)
                    labels.append(label)
                    have.append(g)
                elif have:
                    block = block or Block(have, who, labels)
                    out += [(label, x) for x in block.similar(g, cid, label, num, den).tolist() if joined.join(label, x)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())],
                                             names=["a", "b"])

    full = rows.join(sets, "cid").select("unit", "held", "lot", "role", "cid", "label", "set")
    return (full.repartition("unit", "held", "lot").sortWithinPartitions("unit", "held", "lot", "role")
            .mapInArrow(check, "a long, b long").distinct())


def decide(families: DataFrame, pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between sets that span exactly the components of all pairs
    of one family (``families``: cid, family) with den * shared >= num * union.
    ``pairs`` (q, comp) are tried first; ``sets``: (cid, set)."""
    none = F.lit(0)
    lots = pairs.groupBy("comp").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("lots"))
    held = lots.select(F.col("comp").alias("unit"), none.alias("held"), F.explode(F.sequence(none, F.col("lots") - 1)).alias("lot"),
                       none.alias("role"), F.col("comp").alias("cid"), F.col("comp").alias("label"))
    come = pairs.join(lots, "comp").select(F.col("comp").alias("unit"), none.alias("held"), F.pmod(F.xxhash64("q"), F.col("lots")).cast("int").alias("lot"),
                                           F.lit(1).alias("role"), F.col("q").alias("cid"), F.col("q").alias("label"))
    star = cut(meetings(held.unionByName(come), sets, num, den), "family-star")
    known = components(star).select(F.col("id").alias("cid"), F.col("comp").alias("label"))
    members = cut(families.join(known, "cid", "left").join(sets.select("cid", F.octet_length("set").alias("bytes")), "cid")
                  .select("cid", F.coalesce("label", "cid").alias("label"), "family", "bytes"), "family-members")
    # outside a family's largest joined part: these ask that part and one another
    major = (members.groupBy("family", "label").agg(F.count("*").alias("n")).groupBy("family")
             .agg(F.max_by("label", F.struct("n", "label")).alias("major"), F.count("*").alias("labels")).where("labels > 1"))
    open_ = members.join(major, "family").withColumn("out", F.col("label") != F.col("major"))
    blocks = lambda c: F.greatest(F.ceil(F.count_if(c) / BLOCK), F.ceil(F.sum(F.when(c, F.col("bytes"))) / BLOCK_BYTES)).cast("int")
    sizes = open_.groupBy("family").agg(F.coalesce(blocks(~F.col("out")), none).alias("mb"), F.coalesce(blocks(F.col("out")), none).alias("ob"))
    # blocks of the joined part are numbered first; a meeting is (held block, visiting block)
    placed = open_.join(sizes, "family").withColumn("block", F.when(F.col("out"), F.col("mb") + F.pmod(F.xxhash64("cid"), F.col("ob")))
                                                    .otherwise(F.pmod(F.xxhash64("cid"), F.col("mb"))).cast("int"))
    last = F.col("mb") + F.col("ob") - 1
    held = placed.select(F.col("family").alias("unit"), F.col("block").alias("held"),
                         F.explode(F.sequence(F.greatest("mb", F.when(F.col("out"), F.col("block")).otherwise(none)), last)).alias("lot"),
                         none.alias("role"), "cid", "label")
    come = placed.where("out").select(F.col("family").alias("unit"), F.explode(F.sequence(none, F.col("block"))).alias("held"),
                                      F.col("block").alias("lot"), F.lit(1).alias("role"), "cid", "label")
    return cut(star.unionByName(meetings(held.unionByName(come), sets, num, den)), "family-decided")
