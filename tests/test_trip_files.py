"""The derived trips: read without a shuffle, written without one, the same either way."""

import datetime as dt

import pytest

from rideframe.catalog import fixtures as fx
from rideframe.catalog.filters import filter_positive_duration
from rideframe.catalog.scalars import bin_thresholds

SCHEMA = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def line_items(spark, folder, status):
    rows = [
        (k, 7 * k, k % 5, 1 + k % 7, float(1 + k % 50), 900.0 + 13 * k, (k % 11) / 100, (k % 9) / 100, "NRA"[k % 3], status(k), dt.datetime(1996, 1, 1 + k % 28))
        for k in range(1, 400)
    ]
    twice = [*rows, *rows[:20], (None,) * 11]
    spark.createDataFrame(twice, SCHEMA).repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.fixture
def folder(spark, tmp_path):
    return line_items(spark, tmp_path, lambda k: "OF"[k % 2])


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_local_queries_write_no_trips(spark, folder):
    out = bin_thresholds(spark, folder)
    assert "Exchange" not in executed(out)
    assert all("lineitem" in file for file in out.inputFiles())
    assert out.count() == 420


def test_trips_of_the_duration_filter_are_not_shuffled(spark, folder):
    out = filter_positive_duration(spark, folder)
    assert "Exchange" not in executed(out)
    assert all("lineitem" in file for file in out.inputFiles())


def test_written_trips_are_the_derived_ones(spark, folder):
    derived = fx.trips(spark, folder)
    written = spark.read.parquet(fx.trip_files(spark, folder)).select(derived.columns)
    assert [f.dataType for f in written.schema] == [f.dataType for f in derived.schema]
    assert written.exceptAll(derived).isEmpty() and derived.exceptAll(written).isEmpty()


def test_a_service_without_trips_can_be_read(spark, tmp_path):
    folder = line_items(spark, tmp_path, lambda k: "O")
    assert fx.raw_trips(spark, folder, "green").count() == 1  # the row of nulls
    assert fx.raw_trips(spark, folder, "yellow").count() == 419
