"""Stored price cells: updates by month, replaced partitions, equality with the full run."""

import os
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from rideframe.catalog import fixtures as fx
from rideframe.plans import price_anomaly as price_plan
from rideframe.plans import stored_cells as store
from rideframe.sources.reports import read_report, write_report

SF_DIR = "/root/testdata/sf0.001"
START, END = date(1997, 1, 1), date(1997, 7, 1)


def months(first, after):
    """The firsts of the months from one date to another, the last one included."""
    place = first
    while place <= after:
        yield place
        place = date(place.year + place.month // 12, place.month % 12 + 1, 1)


@pytest.fixture(scope="module")
def raw(spark):
    """Trips of half a year, of both services."""
    return {s: store_rows(df) for s, df in fx.both_services(spark, SF_DIR).items()}


def store_rows(df):
    [pickup] = [c for c in df.columns if c.endswith("pickup_datetime")]
    return df.filter((F.col(pickup) >= F.lit(str(START)).cast("timestamp_ntz")) & (F.col(pickup) < F.lit(str(END)).cast("timestamp_ntz")))


def rows(df):
    return sorted(map(str, df.collect()))


def full_report(raw):
    return rows(price_plan.price_anomaly_services(raw, 1, None))


def files(path, part):
    folder = os.path.join(path, part)
    return sorted(f for f in os.listdir(folder) if f.endswith(".parquet")) if os.path.isdir(folder) else []


@pytest.mark.parametrize("period", ["month", "day"])
def test_report_of_single_months_equals_the_full_one(spark, raw, tmp_path, period):
    path = str(tmp_path / "cells")
    firsts = list(months(START, END))
    steps = list(zip(firsts, firsts[1:]))
    for start, end in steps[::2] + steps[1::2] if period == "month" else [(START, date(1997, 2, 9)), (date(1997, 2, 9), END)]:
        store.update_cells(raw, path, start, end, period)
    report = price_plan.price_anomaly_of_cells(store.read_cells(spark, path, period=period))
    assert rows(report) == full_report(raw)


def test_a_replaced_month_leaves_the_others_alone(spark, raw, tmp_path):
    path = str(tmp_path / "cells")
    store.update_cells(raw, path, START, END)
    march, april = date(1997, 3, 1), date(1997, 4, 1)
    parts = [f"service_type={s}/pickup_month={m}" for s in raw for m in list(months(START, END))[:-1]]
    before = {part: files(path, part) for part in parts}
    assert all(before.values())
    corrected = {
        "yellow": raw["yellow"].withColumn("fare_amount", F.col("fare_amount") + 1),
    }
    store.update_cells(corrected, path, march, april)
    changed = {part for part in parts if files(path, part) != before[part]}
    assert changed == {f"service_type=yellow/pickup_month={march}"}

    pickup = F.col("tpep_pickup_datetime")
    in_march = F.date_format(pickup, "yyyy-MM") == "1997-03"
    now = {
        "yellow": raw["yellow"].withColumn("fare_amount", F.col("fare_amount") + F.when(in_march, 1).otherwise(0)),
        "green": raw["green"],
    }
    assert rows(price_plan.price_anomaly_of_cells(store.read_cells(spark, path))) == full_report(now)


def test_a_month_that_lost_its_trips_is_emptied(spark, raw, tmp_path):
    path = str(tmp_path / "cells")
    store.update_cells(raw, path, START, END)
    store.update_cells({s: df.limit(0) for s, df in raw.items()}, path, date(1997, 2, 1), date(1997, 3, 1))
    cells = store.read_cells(spark, path)
    found = {str(r[0]) for r in cells.select("pickup_month").distinct().collect()}
    assert found == {str(m) for m in months(START, END)} - {"1997-02-01", str(END)}
    assert cells.filter("n_trips <= 0").count() == 0


def test_an_update_twice_is_one(spark, raw, tmp_path):
    path = str(tmp_path / "cells")
    for _ in range(2):
        store.update_cells(raw, path, START, END)
    total = store.read_cells(spark, path).agg(F.sum("n_trips")).first()[0]
    assert total == price_plan.price_trips_services(raw, 1, None).count()


def test_only_stored_months_asked_for_are_read(spark, raw, tmp_path):
    path = str(tmp_path / "cells")
    store.update_cells(raw, path, START, END)
    some = store.read_cells(spark, path, date(1997, 2, 1), date(1997, 4, 1))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*pickup_month.* >= 1997-02-01.*pickup_month.* < 1997-04-01", plan)
    assert len(some.inputFiles()) >= 1
    few = {s: df.filter(F.month(F.col([c for c in df.columns if c.endswith("pickup_datetime")][0])).isin(2, 3)) for s, df in raw.items()}
    assert rows(price_plan.price_anomaly_of_cells(some)) == full_report(few)


def test_the_window_reaches_the_scan_of_trips(spark):
    raw = fx.both_services(spark, SF_DIR)
    plan = store.cells_of_window(raw, START, END)._jdf.queryExecution().executedPlan().toString()
    pushed = re.findall(r"PushedFilters: \[[^\]]*", plan)
    assert len([p for p in pushed if "pickup_datetime" in p]) == 2
    assert "PythonUDF" not in plan and "CartesianProduct" not in plan


def test_empty_trips_and_bad_windows(spark, raw, tmp_path):
    path = str(tmp_path / "cells")
    store.update_cells({s: df.limit(0) for s, df in raw.items()}, path, START, END)
    assert store.read_cells(spark, path).count() == 0
    assert price_plan.price_anomaly_of_cells(store.read_cells(spark, path)).count() == 0
    with pytest.raises(ValueError):
        store.update_cells(raw, path, END, START)
    with pytest.raises(ValueError):
        store.update_cells(raw, path, START, date(1997, 2, 2))
    with pytest.raises(ValueError):
        store.update_cells(raw, path, START, END, "week")
    with pytest.raises(ValueError):
        store.read_cells(spark, path, period="day")


def test_reports_replace_tables_partitions_or_nothing(spark, tmp_path):
    path = str(tmp_path / "report")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    new = spark.createDataFrame([("b", 3)], "k string, v long")

    def stored():
        return sorted((r["k"], r["v"]) for r in read_report(spark, path).collect())

    write_report(df, path, ["k"])
    write_report(new, path, ["k"], replace="partitions")
    assert stored() == [("a", 1), ("b", 3)]
    write_report(new, path, ["k"], replace="nothing")
    assert stored() == [("a", 1), ("b", 3), ("b", 3)]
    write_report(new, path, ["k"])
    assert stored() == [("b", 3)]
    with pytest.raises(ValueError):
        write_report(df, path, replace="partitions")
    with pytest.raises(ValueError):
        write_report(df, path, replace="rows")
