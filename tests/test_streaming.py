"""Row-local operators accept a stream as they are."""

from pyspark.sql import functions as F

from rideframe.catalog import fixtures as fx
from rideframe.functions.dates import duration_minutes
from rideframe.operators import clean, impact
from rideframe.operators.binning import with_threshold_bins
from rideframe.session import new_shared_path
from rideframe.sources.trips import tip_trips
from rideframe.streaming import stream_trips

SF_DIR = "/root/testdata/sf0.001"


def binned(trips):
    trips = clean.drop_incomplete_nan(trips)
    trips = clean.filter_positive_duration(clean.filter_tip_sanity(clean.filter_vendor(trips)))
    minutes = duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"), "exact")
    return with_threshold_bins(impact.enrich_trips(trips.withColumn("trip_duration_min", minutes)))


def test_stream_gives_the_rows_of_the_batch(spark, tmp_path):
    raw = fx.raw_trips(spark, SF_DIR, "green")
    path = new_shared_path(spark, "stream-green")
    raw.repartition(4).write.parquet(path)
    stream = binned(stream_trips(spark, path, "green", max_files_per_trigger=2))
    query = (
        stream.writeStream.format("memory")
        .queryName("binned_trips")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    keys = ["trip_distance_bin", "speed_mph_bin", "trip_hour_bucket"]
    batch = binned(tip_trips(raw, "green"))
    counts = [
        {tuple(r[k] for k in keys): r["count"] for r in df.groupBy(*keys).count().collect()}
        for df in (spark.table("binned_trips"), batch)
    ]
    assert counts[0] == counts[1] and counts[0]
