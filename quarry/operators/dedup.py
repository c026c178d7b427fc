"""Exact-text dedup, duplicate listing, global sequence ids, seeded sample.

Texts are grouped by a compact key (SHA-256 + length), so the shuffle
carries a fixed-size key instead of the whole text. Dedup is one
``groupBy`` with ``min_by``: partial aggregation collapses copies map-side,
so a text repeated millions of times sends one row per map task, never
one giant group to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .features import hash_key
from .profile import text_key


def dedup_keep_first(df: DataFrame, text: str, order: str, keep=None) -> DataFrame:
    """Keep the first row (lowest ``order``) of each distinct text; adds
    ``n_copies``. ``keep`` limits the carried columns (default: all), so a
    caller that only needs ids does not shuffle the texts."""
    cols = list(keep) if keep else df.columns
    g = df.groupBy(text_key(text).alias("_k")).agg(
        F.min_by(F.struct(*cols), F.col(order)).alias("_r"),
        F.count(F.lit(1)).alias("n_copies"),
    )
    return g.select("_r.*", "n_copies")


def show_all_duplicates(df: DataFrame, text: str) -> DataFrame:
    """Every member of a duplicate group (keep=False), with its group size.

    Duplicate keys are found with a partial aggregate, then joined back;
    AQE broadcasts the key set when small and splits skewed partitions of
    the sort-merge join otherwise.
    """
    keyed = df.withColumn("_k", F.coalesce(text_key(text), F.lit("null")))
    dups = keyed.groupBy("_k").agg(F.count(F.lit(1)).alias("n_copies")).where(F.col("n_copies") > 1)
    return keyed.join(dups, "_k", "inner").drop("_k")


PER_RANGE = 20                   # sampled keys per range


def range_bounds(df: DataFrame, order: list[str], ranges: int) -> list[tuple]:
    """Keys that cut ``df`` into about equal ranges, from a hash sample of its
    distinct keys (about ``PER_RANGE`` per range)."""
    every = max(1, df.count() // (ranges * PER_RANGE))
    sample = (df.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0).distinct()
              .orderBy(*order).collect())
    step = max(1, len(sample) // ranges)
    return [tuple(r) for r in sample[step::step]][:ranges - 1]


def sequence_id(df: DataFrame, order, out: str = "seq", ranges: int | None = None) -> DataFrame:
    """Dense 0-based ids in ``order`` without a single-partition window.

    Fixed bounds, taken from a sample when the query is built, give every row
    the number of its range; rows per range are counted into a table of one row
    per range, whose running sums are broadcast, and a window numbers the rows
    inside each range. A row's range depends on its key alone, so a task that
    runs again gives the same ids, and no row is stored in between. By default
    there are as many ranges as shuffle partitions."""
    order = [order] if isinstance(order, str) else list(order)
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    types = {f.name: f.dataType for f in df.schema.fields}
    literal = lambda key: F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order, key)])
    bounds = range_bounds(df, order, n)
    # two steps, so that a row is compared with about 2 sqrt(n) bounds
    width = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    key = F.struct(*order)
    below = lambda keys: F.size(F.filter(F.array(*map(literal, keys)), lambda b: b <= key)) if keys else F.lit(0)
    if groups:
        coarse = below([g[0] for g in groups])
        fine = F.when(F.col("_c") == 0, 0)
        for i, g in enumerate(groups):
            fine = fine.when(F.col("_c") == i + 1, below(g) + i * width)
        numbered = df.withColumn("_c", coarse).withColumn("_range", fine.cast("int")).drop("_c")
    else:
        numbered = df.withColumn("_range", F.lit(0))
    counts = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)                  # one row per range
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (numbered.withColumn("_local", local).join(F.broadcast(offsets), "_range")
            .withColumn(out, F.col("_off") + F.col("_local")).drop("_range", "_local", "_off"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows picked by a seeded hash of the key (top-k, no full sort), the
    same hash as the stratified split's."""
    return df.orderBy(hash_key(key, seed), key).limit(n)
