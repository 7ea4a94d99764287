"""Distinct rows by digest: the same rows as a plain distinct, and less to shuffle."""

import pytest

from rideframe.catalog import fixtures as fx
from rideframe.operators.distinct import distinct_by_digest
from rideframe.plans import tip_impact as tip_plan

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "a double, b string, c timestamp_ntz, d int"
ODD = [
    (float("nan"), "x", None, 1),
    (float("nan"), "x", None, 1),
    (0.0, "", None, None),
    (-0.0, "", None, None),
    (None, None, None, None),
    (None, None, None, None),
    (1.0, None, None, 2),
    (None, "1.0", None, 2),
    (2.0, "y", None, 3),
]


def rows(df):
    return sorted(map(str, df.collect()))


def shuffled(spark, work):
    """Bytes that all jobs of ``work`` write to shuffles."""

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()

    before = total()
    work()
    return total() - before


@pytest.mark.parametrize("broadcast_bytes", [16 * 2**20, 0])
def test_odd_rows_equal_a_plain_distinct(spark, broadcast_bytes):
    df = spark.createDataFrame(ODD, SCHEMA)
    result = distinct_by_digest(df, broadcast_bytes=broadcast_bytes)
    assert result.columns == df.columns
    assert [f.dataType for f in result.schema] == [f.dataType for f in df.schema]
    plain = [r.replace("-0.0", "0.0") for r in rows(df.dropDuplicates())]
    assert sorted(r.replace("-0.0", "0.0") for r in rows(result)) == sorted(plain)
    assert len(plain) == 6


def test_empty_hot_and_clashing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert distinct_by_digest(empty).collect() == []
    hot = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) as v", "'n' as n")
    assert distinct_by_digest(hot).count() == 20_001
    with pytest.raises(ValueError):
        distinct_by_digest(spark.range(1).selectExpr("id as __DIGEST"))


def test_digests_are_less_to_shuffle_than_rows(spark):
    trips = tip_plan.plausible_tip_trips(fx.both_services(spark, "/root/testdata/sf0.01")).cache()
    trips.count()
    found = {}
    by_rows = shuffled(spark, lambda: found.update(rows=trips.dropDuplicates().count()))
    by_digest = shuffled(spark, lambda: found.update(digests=distinct_by_digest(trips).count()))
    trips.unpersist()
    print("bytes shuffled by rows, by digests:", by_rows, by_digest)
    assert found["rows"] == found["digests"]
    assert by_digest * 2 < by_rows


def test_tip_reports_are_the_same(spark):
    raw = fx.both_services(spark, SF_DIR)
    raw["yellow"] = raw["yellow"].unionByName(raw["yellow"].limit(500))
    weather = fx.weather(spark, SF_DIR), fx.wmo_lookup(spark, SF_DIR)

    def reports(distinct):
        with_weather = tip_plan.tip_impact_weather_services(raw, *weather, quantile_method="exact", distinct=distinct)
        counts = tip_plan.tip_impact_df(raw, quantile_method="exact", distinct=distinct)["allCombinationsImpact"]
        return {
            "features": {(r[0], r[1]): round(r[2], 9) for r in with_weather["all_features"].collect()},
            "trips": sorted((*map(str, r[: len(tip_plan.IMPACT_KEYS)]), r["count_trips"]) for r in counts.collect()),
        }

    assert reports("digests") == reports("rows")
    with pytest.raises(ValueError):
        tip_plan.tip_impact_df(raw, distinct="values")
