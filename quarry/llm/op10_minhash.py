"""Near-duplicate documents by a signature-coordinate inverted join.

Every text becomes its set of word shingles; texts with equal sets are one
class, and the smallest id stands for it. Each class has a MinHash signature:

* ``COORDS`` coordinates, whose (coordinate, value) pairs are the posting
  keys, hashed to a long each;
* a sketch of ``SKETCH`` bytes, one per coordinate of a longer signature,
  for counting collisions without reading the sets.

Two sets with similarity 0.8 agree in fewer than ``MATCH`` of 64 coordinates,
or in fewer than ``SKETCH_MATCH`` of 512 sketch bytes, less than once in a
million times; no list, bucket or number of partners is capped.

Prefix: with all pairs in one order, rarest first, two signatures that agree
in MATCH pairs share one among their first COORDS - MATCH + 1. Pairs held by a
single class come first and cannot match, so most classes post little or
nothing. Merging skips in two steps:

1. star: in every posting list the smallest id leads; each class takes the
   leader it collides with most often, if the sketches agree. This costs one
   pair per class and joins the bulk of every group of near copies.
2. lists: classes connected by such pairs are a family. A list whose members are
   one family is skipped; in the others members of different families are
   compared by sketch, and links that join two families widen them.

``families`` holds these steps. All pairs of one family are decided on the full
sets, so every pair that passes the bounds is decided exactly; a group of near
misses is a family like any other and never written out as pairs. Components
come from ``components``.

Sets hold 64-bit hashes of shingles (polynomial hashes of words, mixed), so
two texts built to collide under them would count as sharing a shingle.

Defined cases: words are lower-cased (A-Z); a text with fewer words than a
shingle has its whole sequence as its one shingle; null, empty and blank texts
have an empty set and stand alone. Rows that repeat an id are versions of one
document: classes that share their smallest id count as one. A null id is the
smallest id. Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (NULL_ID, SPACED, U64, cut, hot_join, key_text, mix, restore_id, utf8, word_pieces, word_hashes)
from .components import components
from .families import decide, star_pairs, widen

COORDS, MATCH = 64, 34
SKETCH, SKETCH_MATCH = 512, 362
_R = np.random.default_rng(20)
MUL = _R.integers(0, 2 ** 63, COORDS, dtype=np.uint64) * U64(2) + U64(1)
MUL32 = _R.integers(0, 2 ** 31, SKETCH - COORDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
COORD = np.arange(1, COORDS + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------ sets

def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one document's word hashes."""
    n = max(1, len(h) - k + 1) if len(h) else 0
    g = np.full(n, min(k, len(h)), U64)
    for j in range(min(k, len(h))):
        g = g * U64(0x9E3779B97F4A7C15) + h[j:j + n]
    return mix(g)


def shingle_sets(batch: pa.RecordBatch, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a batch."""
    data, off = utf8(batch.column("text"))
    whole: list[np.ndarray] = []
    held = np.zeros(0, U64)                    # last words of a long text's earlier pieces
    more = False
    for _, d, o, _, _, rows, _, last in word_pieces(data, off, SPACED, 0):
        _, _, _, h = word_hashes(d, o, SPACED, lower=True)
        if last and not more:
            at = np.searchsorted(rows, np.arange(len(o)))
            for r in range(len(o) - 1):
                yield distinct(shingle_hashes(h[at[r]:at[r + 1]], k))
            continue
        # one long text in several pieces; words too few for a shingle wait for the next piece
        h = np.concatenate([held, h])
        if len(h) >= k:
            whole.append(distinct(shingle_hashes(h, k)))
        held, more = h[max(0, len(h) - k + 1):], not last
        if last:
            yield distinct(np.concatenate(whole)) if whole else distinct(shingle_hashes(h, k))
            whole, held = [], np.zeros(0, U64)


def distinct(g: np.ndarray) -> np.ndarray:
    g = np.sort(g)
    return g[np.r_[True, g[1:] != g[:-1]]] if len(g) else g


def signature(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posting keys and sketch of a set."""
    low, low32 = np.full(COORDS, 2 ** 64 - 1, U64), np.full(len(MUL32), 2 ** 32 - 1, np.uint32)
    for a in range(0, len(g), 2048):
        part = g[a:a + 2048]
        low = np.minimum(low, (part[None, :] * MUL[:, None]).min(1))
        low32 = np.minimum(low32, ((part >> U64(32)).astype(np.uint32)[None, :] * MUL32[:, None]).min(1))
    keys = mix(low ^ COORD)
    return keys, np.concatenate([(keys >> U64(56)).astype(np.uint8), (mix(low32.astype(U64)) >> U64(56)).astype(np.uint8)])


SIGNED = "doc_id long, text_key long, n_shingles long, set_key binary, keys array<long>, sketch binary"


def signing(k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, set_key, keys, sketch = [], [], [], []
            for g in shingle_sets(b, k):
                n.append(len(g))
                set_key.append(hashlib.blake2b(g.tobytes(), digest_size=16).digest() if len(g) else None)
                if len(g):
                    x, s = signature(g)
                    keys.append(x.view(np.int64))
                    sketch.append(s.tobytes())
                else:
                    keys.append(np.zeros(0, np.int64))
                    sketch.append(None)
            at = np.r_[0, np.cumsum([len(x) for x in keys])].astype(np.int32)
            values = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(n, pa.int64()), pa.array(set_key, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(values)), pa.array(sketch, pa.binary())],
                names=[x.split()[0] for x in SIGNED.split(", ")])
    return task


def set_bytes(k: int):
    def task(batches):
        for b in batches:
            sets = [g.tobytes() for g in shingle_sets(b, k)]
            yield pa.RecordBatch.from_arrays([b.column("cid"), pa.array(sets, pa.binary())], names=["cid", "set"])
    return task


# ------------------------------------------------------------ postings

def postings(signed: DataFrame) -> DataFrame:
    """(key, cid): every class under the keys of its prefix that another class has, too."""
    pairs = signed.select("cid", F.explode("keys").alias("key"))
    shared = cut(pairs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "minhash-shared")
    ordered = (pairs.join(shared, "key").groupBy("cid")
               .agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("p")))
    # keys of no other class are rarer and stand before these
    room = F.greatest(F.lit(0), F.lit(COORDS - MATCH + 1) - (F.lit(COORDS) - F.size("p")))
    return ordered.select("cid", F.explode(F.slice("p", F.lit(1), room)).alias("x")).select(F.col("x.key").alias("key"), "cid")


def agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Do rows of two arrays of sketches collide in enough bytes?"""
    return (a == b).sum(1, dtype=np.int32) >= SKETCH_MATCH


# ------------------------------------------------------------ operator

def near_duplicates(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) of every row: components
    of the links with den * shared >= num * union on sets of ``shingle`` words."""
    if num * 100 < 80 * den:
        raise ValueError("the match thresholds are made for similarities of 0.8 and more")
    keyed = key_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    signed = cut(keyed.mapInArrow(signing(shingle), SIGNED), "minhash-signed")
    classes = cut(signed.where("n_shingles > 0").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.count("*").alias("n"))
        .select("set_key", F.col("first.doc_id").alias("cid"), F.col("first.text_key").alias("text_key"), "n"), "minhash-classes")
    heads = classes.select("cid", "text_key")
    lead = (signed.join(heads.withColumnRenamed("cid", "doc_id"), ["doc_id", "text_key"], "left_semi")
            .dropDuplicates(["doc_id", "text_key"]).select(F.col("doc_id").alias("cid"), "text_key", "keys", "sketch"))
    lead = cut(lead, "minhash-heads")
    posted = cut(postings(lead), "minhash-postings")

    def sets_of(ids: DataFrame) -> DataFrame:
        """(cid, set) of the classes asked about, from their texts. Their
        number grows with the input, so the texts go by sort-merge at any size."""
        wanted = cut(heads.join(ids, "cid", "left_semi").withColumnRenamed("cid", "doc_id"), "minhash-wanted")
        return cut(keyed.join(wanted.hint("merge"), ["doc_id", "text_key"], "left_semi").select(F.col("doc_id").alias("cid"), "text")
                   .mapInArrow(set_bytes(shingle), "cid long, set binary"), "minhash-sets")

    sketches = lead.select("cid", F.col("sketch").alias("payload"))
    pairs = cut(star_pairs(posted, sketches, agree), "minhash-star")
    members = widen(posted, sketches, pairs, agree)
    links = decide(members, pairs, sets_of(members.select("cid")), num, den)
    labels = components(links)
    found = classes.join(labels.withColumnRenamed("id", "cid"), "cid", "left").select(
        "set_key", F.coalesce("comp", "cid").alias("component_id"), "n", "cid").where("n > 1 OR component_id <> cid").drop("cid")
    found = cut(found, "minhash-found")
    base = signed.select("doc_id", "text_key", "n_shingles", "set_key")
    return hot_join(base, found, "set_key", "n", base.count()).select(
        "doc_id", "text_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, all
    columns as they are; rows that repeat an id and text stay once."""
    stay = near_duplicates(docs, shingle, num, den).where("doc_id = component_id").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    keyed = docs.withColumns({"_id": F.coalesce(F.col("doc_id"), F.lit(NULL_ID)),
                              "_key": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    return keyed.join(stay, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"]).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=2)
    return out.select(restore_id(), "n_shingles", restore_id("component_id"),
                      (F.col("doc_id") == F.col("component_id")).alias("kept"))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS g
      FROM d, unnest(range(1, greatest(2, len(w)))) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) c USING (doc_id)
"""
