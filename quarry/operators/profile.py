"""Corpus profiling: counts, shares, describe, nulls, text quality,
duplicates, pattern presence, top words, histograms.

Every profile is one or two aggregations. Aggregations are partial (map-side
combine) and group by small keys (label, field, term). Exact quartiles of
integers use ``percentile``, whose state is a value -> count map bounded by the
number of distinct values (lengths); those of real numbers narrow a histogram
in a few passes (``quantiles``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.fixed import SPARK_ENGLISH_STOP_WORDS
from ..functions.text import n_words, noise_ratios, py_strip

R = 4  # decimals kept on double outputs


def value_counts(df: DataFrame, c: str, keep_null: bool = False) -> DataFrame:
    d = df if keep_null else df.where(F.col(c).isNotNull())
    return d.groupBy(c).agg(F.count(F.lit(1)).alias("count"))


def class_share(df: DataFrame, label: str) -> DataFrame:
    counts = value_counts(df, label)
    # the total is a scalar subquery over the per-class counts
    tot = counts.agg(F.sum("count")).scalar()
    return counts.select(label, F.round(F.col("count") * 100.0 / tot, 2).alias("pct"))


BINS = 1024                      # per pass and order statistic


def order_statistics(df: DataFrame, wanted: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """The values of the given 0-based ranks of each column, nulls left out.

    Every rank starts with its column's whole interval. A pass counts the
    values of all ranks' intervals in ``BINS`` bins, with the least and the
    largest value of each bin; the bin that holds the rank is the next interval,
    until its ends are equal. A pass is one aggregate with at most BINS groups
    per rank, whatever the number of rows or of different values."""
    if not wanted:
        return {}
    ends = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in wanted for n, f in (("low", F.min), ("high", F.max))]).first()
    open_ = {(c, k): (ends[f"low_{c}"], ends[f"high_{c}"], k) for c, ranks in wanted.items() for k in ranks}
    found = {}
    while open_:
        for key, (low, high, _) in list(open_.items()):
            if low == high:
                found[key] = low
                del open_[key]
        if not open_:
            break
        keys = list(open_)
        cells = []
        for i, (c, k) in enumerate(keys):
            low, high, _ = open_[c, k]
            x = F.col(c).cast("double")
            share = (x - F.lit(low)) / F.lit(high - low)              # grows with x, so bins are in order
            cells.append(F.when(x.between(low, high), F.struct(
                F.lit(i).alias("i"), F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int").alias("bin"), x.alias("x"))))
        rows = (df.select(F.explode(F.filter(F.array(*cells), lambda s: s.isNotNull())).alias("s"))
                .groupBy("s.i", "s.bin").agg(F.count(F.lit(1)).alias("n"), F.min("s.x").alias("low"), F.max("s.x").alias("high"))
                .orderBy("i", "bin").collect())
        left = {i: open_[key][2] for i, key in enumerate(keys)}
        for r in rows:
            if left.get(r.i) is None:
                continue
            if left[r.i] < r.n:
                open_[keys[r.i]] = (r.low, r.high, left[r.i])
                left[r.i] = None
            else:
                left[r.i] -= r.n
    return found


def quantiles(df: DataFrame, cols: list[str], shares=(0.25, 0.5, 0.75)) -> dict[str, list[float | None]]:
    """Exact quantiles of each column, linear between neighbours."""
    n = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    at = {c: [(n[c] - 1) * q for q in shares] if n[c] else [] for c in cols}
    wanted = {c: sorted({k for h in hs for k in (int(h), min(int(h) + 1, n[c] - 1))}) for c, hs in at.items() if hs}
    value = order_statistics(df, wanted)
    line = lambda c, h: value[c, int(h)] + (value[c, min(int(h) + 1, n[c] - 1)] - value[c, int(h)]) * (h - int(h))
    return {c: [line(c, h) for h in at[c]] or [None] * len(shares) for c in cols}


def describe(df: DataFrame, cols: list[str], group: str | None = None, exact: dict[str, list[float | None]] | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear), max per column.
    Quartiles come from ``percentile``, whose state is a count per different
    value and so fits lengths and other integers; for real numbers pass those
    of ``quantiles`` as ``exact``."""
    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        q = [F.lit(v).cast("double") for v in exact[c]] if exact else F.percentile(x, [0.25, 0.5, 0.75])
        aggs = [
            F.count(x).alias("count"), F.round(F.avg(x), R).alias("mean"),
            F.round(F.stddev_samp(x), R).alias("std"), F.min(x).alias("min"),
            F.round(q[0], R).alias("p25"), F.round(q[1], R).alias("p50"),
            F.round(q[2], R).alias("p75"), F.max(x).alias("max"),
        ]
        g = df.groupBy(group) if group else df
        named = g.agg(*aggs)
        parts.append(named.select(*([group] if group else []), F.lit(c).alias("column"), *named.columns[1 if group else 0:]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_profile(df: DataFrame, top_n: int = 20) -> DataFrame:
    """Nulls and percent per column, most first, top n."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    long = wide.select("_n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in df.columns])))
    return (long.select("column", "n_null",
                        F.round(F.try_divide(F.col("n_null") * 100.0, F.col("_n")), 2).alias("pct"))
            .orderBy(F.desc("n_null"), "column").limit(top_n))


def text_quality_counts(df: DataFrame, text: str, under: int = 20) -> DataFrame:
    s = py_strip(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "").alias("empty"),
        F.round(F.avg((s == "").cast("double")) * 100, 2).alias("empty_pct"),
        F.count_if(n_words(s) < under).alias(f"under_{under}_words"),
    )


def text_key(c) -> Column:
    """Compact key for long texts: 256-bit digest plus length. The key of a
    null text is null: no value in distinct counts, one group in groupings."""
    col = F.col(c) if isinstance(c, str) else c
    return F.concat(F.sha2(col, 256), F.lit(":"), F.length(col).cast("string"))


def duplicate_rate(df: DataFrame, text: str) -> DataFrame:
    """Rows beyond the first of each distinct text, and their percent."""
    per = df.groupBy(text_key(text).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        (F.sum("n") - F.count(F.lit(1))).alias("duplicates"),
        F.round((F.sum("n") - F.count(F.lit(1))) * 100.0 / F.sum("n"), 2).alias("duplicate_pct"),
    )


def feature_presence(df: DataFrame, flags: list[tuple[str, Column]], group: str | None = None) -> DataFrame:
    """Percent of rows where each flag holds, one row per flag."""
    aggs = [F.avg(c.cast("double")).alias(n) for n, c in flags]
    g = df.groupBy(group) if group else df
    wide = g.agg(*aggs)
    keep = [group] if group else []
    return wide.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.round(F.col(f"`{n}`") * 100, 2).alias("pct"))
        for n, _ in flags])))


def flags_from(patterns, text: str) -> list[tuple[str, Column]]:
    out = []
    for name, pat, ci in patterns:
        out.append((name, F.col(text).rlike(("(?iU)" if ci else "(?U)") + pat)))
    return out


def english_stop_words() -> tuple[str, ...]:
    """Spark ML's default English stop-word list."""
    return SPARK_ENGLISH_STOP_WORDS


WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens(c) -> Column:
    """Lower-cased runs of 2+ word characters (letters, numbers, '_')."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(col), F.lit(WORD_TOKEN), 0)


def top_words(df: DataFrame, text: str, n: int, group: str | None = None) -> DataFrame:
    """Most frequent non-stop tokens (per group), ties by word."""
    keep = [group] if group else []
    stop = df.sparkSession.createDataFrame([(w,) for w in english_stop_words()], "word string")
    t = df.select(*keep, F.explode(tokens(text)).alias("word"))
    t = t.join(F.broadcast(stop), "word", "left_anti")  # fixed-size list (~180 rows)
    counts = t.groupBy(*keep, "word").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*keep).orderBy(F.desc("count"), "word") if keep else None
    if w is None:
        return counts.orderBy(F.desc("count"), "word").limit(n)
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def length_histogram(df: DataFrame, c: str, bins: int, group: str | None = None) -> DataFrame:
    """Equal-width bins between min and max; the top edge is in the last bin.

    min/max are scalar subqueries (one aggregate, no join, no collect).
    """
    keep = [group] if group else []
    x = F.col(c).cast("double")
    bounds = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    j = (df.select(*keep, x.alias("x")).where(F.col("x").isNotNull())
         .withColumn("lo", bounds["lo"]).withColumn("hi", bounds["hi"]))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    out = j.groupBy(*keep, b.alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    return out.select(*keep, "bin", "count",
                      F.round(F.col("lo") + F.col("bin") * width, R).alias("left_edge"))


def noise_profile(df: DataFrame, text: str) -> DataFrame:
    """describe of the four ratios, quartiles from the ratios as they are
    (``quantiles`` looks at them several times, so they are kept meanwhile)."""
    ratios = noise_ratios(text)
    numbers = df.select(*[v.alias(k) for k, v in ratios.items()])
    kept = numbers.cache()
    exact = quantiles(kept, list(ratios))
    kept.unpersist()
    return describe(numbers, list(ratios), exact=exact)


def schema_profile(df: DataFrame) -> DataFrame:
    """Column name, type, non-null count and row count."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count(F.col(c)).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`{c}`").alias("non_null"),
                 F.col("_n").alias("n_rows"))
        for c, t in df.dtypes])))
