"""Quantiles from sketches: rank error, groups, merging, and values that are not numbers."""

import math

import pytest
from pyspark.sql import functions as F

from rideframe.operators.quantile_sketches import (
    merge_sketches,
    quantile_sketches,
    sketch_quantiles,
    sketch_size,
    trim_by_sketch,
)
from rideframe.operators.quantiles import exact_quantiles_by_key, trim_outliers

POINTS = [0.0, 0.02, 0.5, 0.98, 1.0]


def skewed(spark, n=60_000):
    """Group a holds most of the rows, and a third of its values are equal."""
    return spark.range(n, numPartitions=7).selectExpr(
        "id % 17 as day",
        "case when id % 10 = 0 then 'b' else 'a' end as service",
        "case when id % 3 = 0 then 7.0 else pow(cast(hash(id) as double) % 1000, 3) end as x",
        "cast(id as double) as y",
    )


def check_ranks(df, found, error=0.01):
    for row in found:
        own = df.filter(F.col("service") == row.service)
        n = own.count()
        for c in ("x", "y"):
            for q, value in zip(POINTS, row[c]):
                below, upto = own.agg(F.count_if(F.col(c) < value), F.count_if(F.col(c) <= value)).first()
                assert below <= (q + error) * n and upto >= (q - error) * n, (row.service, c, q)


def test_ranks_of_every_group(spark):
    df = skewed(spark)
    found = sketch_quantiles(quantile_sketches(df, ["x", "y"], ["service"]), ["x", "y"], POINTS).collect()
    assert {r.service for r in found} == {"a", "b"}
    check_ranks(df, found)


def test_merged_days_are_as_exact_as_all_rows_at_once(spark):
    df = skewed(spark)
    days = quantile_sketches(df, ["x", "y"], ["service", "day"])
    merged = merge_sketches(days, ["x", "y"], ["service"])
    sizes = merged.select("service", F.kll_sketch_get_n_double("x").alias("n")).collect()
    assert {r.service: r.n for r in sizes} == {"a": 54_000, "b": 6_000}
    check_ranks(df, sketch_quantiles(merged, ["x", "y"], POINTS).collect())


def test_small_groups_are_exact(spark):
    df = spark.range(101).selectExpr("'s' as service", "cast(id as double) as x")
    [row] = sketch_quantiles(quantile_sketches(df, ["x"], ["service"]), ["x"], POINTS).collect()
    assert row.x[0] == 0 and row.x[2] == 50 and row.x[-1] == 100


def test_nulls_nan_infinities_and_empty_groups(spark):
    nan, inf = math.nan, math.inf
    rows = [("a", None), ("a", nan), ("b", 1.0), ("b", nan), ("b", inf), ("b", -inf), (None, 3.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "service string, x double")
    found = sketch_quantiles(quantile_sketches(df, ["x"], ["service"]), ["x"], [0.0, 1.0]).collect()
    assert {r.service: r.x for r in found} == {"a": None, "b": [-inf, inf], None: [3.0, 3.0]}
    kept = trim_by_sketch(df, ["x"], (0.0, 1.0), ["service"]).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [("b", 1.0), ("b", inf), ("b", -inf), (None, 3.0), (None, 3.0)]))
    for empty in (df.limit(0), df.filter("service = 'a'")):
        assert trim_by_sketch(empty, ["x"], (0.0, 1.0)).count() == 0
        assert trim_by_sketch(empty, ["x"], (0.0, 1.0), ["service"]).count() == 0


def test_trimmed_rows_keep_their_columns_and_repeats(spark):
    df = skewed(spark, 6000).withColumn("__low", F.lit(1))
    df = df.unionAll(df)
    kept = trim_by_sketch(df, ["y"], (0.02, 0.98), ["service"])
    assert kept.columns == df.columns
    counts = {r[0]: r[1] for r in kept.groupBy("service").count().collect()}
    assert abs(counts["a"] - 0.96 * 10_800) <= 0.02 * 10_800 and abs(counts["b"] - 0.96 * 1200) <= 0.02 * 1200
    assert kept.groupBy(*df.columns).count().filter("count % 2 = 1").count() == 0


def test_every_use_sees_the_same_bounds(spark):
    kept = trim_by_sketch(skewed(spark), ["x", "y"], (0.02, 0.98), ["service"])
    assert kept.exceptAll(kept).count() == 0 and kept.count() == kept.count()


def test_bounds_without_keys_filter_without_a_join(spark):
    kept = trim_by_sketch(skewed(spark), ["x", "y"], (0.02, 0.98))
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "CartesianProduct" not in text
    assert abs(kept.count() - 0.93 * 60_000) < 0.05 * 60_000


def test_exact_bounds_by_key(spark):
    df = skewed(spark, 6000)
    found = exact_quantiles_by_key(df, ["y"], [0.0, 0.5, 1.0], "service", ["a", "b", "none"])
    for service in ("a", "b"):
        own = sorted(r[0] for r in df.filter(F.col("service") == service).select("y").collect())
        assert found[service]["y"] == [own[0], own[math.ceil(len(own) / 2) - 1], own[-1]]
    assert found["none"]["y"] == [None, None, None]
    kept = trim_outliers(df, ["y"], (0.5, 1.0), "exact", key="service", values=["a", "none"])
    assert kept.count() == df.filter(F.col("service") == "a").filter(F.col("y") >= found["a"]["y"][1]).count()
    with pytest.raises(ValueError):
        trim_outliers(df, ["y"], method="other", key="service", values=["a"])


def test_sizes(spark):
    assert sketch_size(0.01) < sketch_size(0.001)
    for error in (0, 1, 1e-6):
        with pytest.raises(ValueError):
            sketch_size(error)
