"""Sources, sinks and the shared folder."""

import pytest
from pyspark.sql import functions as F

from rideframe import session
from rideframe.sources import reports, trips, weather


def test_lookup_keeps_commas(spark, tmp_path):
    path = tmp_path / "wmo.csv"
    path.write_text("code;description\n51;Drizzle, light\n 0 ; Clear sky \n")
    rows = {r["wmo_code"]: r["description"] for r in weather.read_wmo_lookup(spark, str(path)).collect()}
    assert rows == {51: "Drizzle, light", 0: "Clear sky"}


def test_weather_cells_are_trimmed(spark, tmp_path):
    path = tmp_path / "weather.csv"
    path.write_text("time,weather.code\n 2024-01-02 , 61 \n")
    [row] = weather.read_weather(spark, str(path)).collect()
    assert (str(row["date"]), row["wmo_code"]) == ("2024-01-02", 61)


def test_absent_columns_stay_absent_and_bad_text_is_null(spark):
    raw = spark.createDataFrame(
        [("2024-01-01 10:00:00", "x", "Y")],
        "lpep_pickup_datetime string, Passenger_Count string, other string",
    )
    df = trips.canonical_trips(raw, "green")
    assert df.columns == ["service_type", "pickup_datetime", "passenger_count"]
    [row] = df.collect()
    assert row["passenger_count"] is None and row["pickup_datetime"].hour == 10


def test_second_write_replaces_the_first(spark, tmp_path):
    path = str(tmp_path / "report")
    reports.write_report(spark.range(5), path)
    reports.write_report(spark.range(3), path, single_file=True)
    assert reports.read_report(spark, path).count() == 3
    assert len(list((tmp_path / "report").glob("*.parquet"))) == 1


def test_staged_table_keeps_schema_and_rows(spark):
    df = spark.range(10).select("id", F.lit("a").alias("b"))
    staged = session.stage(df, "test")
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert staged.count() == 10


def test_shared_folder_comes_from_the_session(spark):
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    if wanted:
        assert session.shared_folder(spark) == wanted.rstrip("/")
    first, second = (session.new_shared_path(spark, "x") for _ in range(2))
    assert first != second


class FakeContext:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class FakeSession:
    sparkContext = FakeContext()

    class conf:
        @staticmethod
        def get(key, default):
            return default


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError):
        session.shared_folder(FakeSession())


def test_partition_count_follows_the_input():
    assert session.shuffle_partitions_for(1000, 8) == 8
    assert session.shuffle_partitions_for(2**40, 400) == 8192
    assert session.shuffle_partitions_for(100 * 2**40, 4000) == session.MAX_SHUFFLE_PARTITIONS
