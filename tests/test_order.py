"""Exact quantiles and dense ids without a global sort: against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import dedup, profile


def test_quantiles_equal_numpy(spark, monkeypatch):
    monkeypatch.setattr(profile, "BINS", 8)                      # many passes
    r = np.random.default_rng(1)
    cols = {"even": r.random(997), "skewed": np.exp(r.normal(0, 8, 997)), "ties": r.integers(0, 3, 997).astype(float), "same": np.full(997, 0.25)}
    rows = [tuple(float(v) for v in x) for x in zip(*cols.values())]
    df = spark.createDataFrame(rows + [(None, None, None, None)], list(cols)).repartition(5)
    got = profile.quantiles(df, list(cols))
    for c, v in cols.items():
        assert np.allclose(got[c], np.quantile(v, [0.25, 0.5, 0.75]), rtol=1e-12, atol=0)
    ranks = profile.order_statistics(df, {"skewed": [0, 17, 996], "ties": [0, 500]})
    assert [ranks["skewed", k] for k in (0, 17, 996)] == [float(np.sort(cols["skewed"])[k]) for k in (0, 17, 996)]
    assert profile.quantiles(df.limit(0), ["even"]) == {"even": [None, None, None]}


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_sequence_ids_are_dense_and_ordered(spark, ranges):
    r = np.random.default_rng(2)
    keys = [None] + [int(x) for x in r.permutation(5000)[:1200]]
    df = spark.createDataFrame([(k, f"n{k}") for k in keys], "k long, name string").repartition(6)
    got = {x.name: x.seq for x in dedup.sequence_id(df, "k", "seq", ranges).collect()}
    want = {f"n{k}": i for i, k in enumerate(sorted(keys, key=lambda k: (k is not None, k)))}
    assert got == want


def test_sequence_ids_over_two_columns(spark):
    rows = [(f"g{i % 4}", float(i * 37 % 101)) for i in range(101)]
    out = dedup.sequence_id(spark.createDataFrame(rows, "g string, x double"), ["g", "x"], ranges=9)
    assert {(x.g, x.x): x.seq for x in out.collect()} == {k: i for i, k in enumerate(sorted(rows))}


def test_ranges_are_about_equal(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"))
    bounds = [b[0] for b in dedup.range_bounds(df, ["k"], 10)]
    sizes = np.diff([0, *bounds, 20_000])
    assert len(bounds) == 9 and sizes.max() < 3 * sizes.mean()


def test_the_checkpoint_folder_does_not_nest(spark):
    from quarry.session import scratch_path
    first = scratch_path(spark, "x")
    folder = spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x") == first and spark.sparkContext.getCheckpointDir() == folder
