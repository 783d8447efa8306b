from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from ridelake.functions import rides
from ridelake.operators import bronze, gold, silver
from ridelake.plans import medallion
from ridelake.sources import sinks, tables

SCHEMA = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count bigint, "
    "trip_distance double, fare_amount double, total_amount double, PULocationID bigint, DOLocationID bigint"
)
NOON = dt.datetime(2024, 1, 15, 12)


def trip(vendor=1, start=NOON, minutes=10, people=1, miles=2.0, fare=10.0, total=12.0, pu=5, do=6):
    end = None if start is None else start + dt.timedelta(minutes=minutes)
    return (vendor, start, end, people, miles, fare, total, pu, do)


def trips(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_missing_columns_are_named(spark):
    df = trips(spark, trip())
    assert bronze.validate_schema(df) == ["PULocationID", "DOLocationID"]
    with pytest.raises(ValueError, match="fare_amount"):
        bronze.validate_schema(df.drop("fare_amount"))


def test_green_files_reach_bronze(spark):
    green = spark.sql(
        "SELECT 1L AS VendorID, timestamp_ntz'2024-01-02 03:04:05' AS lpep_pickup_datetime, timestamp_ntz'2024-01-02 03:14:05' "
        "AS lpep_dropoff_datetime, 1L AS passenger_count, 1D AS trip_distance, 5D AS fare_amount, 6D AS total_amount"
    )
    made = bronze.bronze_table(green, "2024-02-01").first()
    assert (made.year, made.month, made.tpep_pickup_datetime.hour) == (2024, 1, 3)


def test_the_preferred_vendor_column_wins(spark):
    both = spark.sql("SELECT 1 AS VendorID, 2 AS vendor_id")
    names = {"VendorID": rides.NAME_VARIANTS["VendorID"]}
    assert [tuple(r.asDict().items()) for r in rides.resolve_columns(both, names).collect()] == [(("VendorID", 2),)]


def test_green_names_are_resolved_and_missing_ones_raise(spark):
    green = trips(spark, trip()).withColumnsRenamed(
        {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}
    )
    assert "tpep_pickup_datetime" in rides.resolve_columns(green).columns
    with pytest.raises(KeyError):
        rides.resolve_columns(green.drop("VendorID"))


@pytest.mark.parametrize(
    "row, kept",
    [
        (trip(), True),
        (trip(fare=0.0), True),
        (trip(fare=-0.01), False),
        (trip(total=-1.0), False),
        (trip(people=0), False),
        (trip(people=6), True),
        (trip(people=7), False),
        (trip(people=None), False),
        (trip(miles=None), False),
        (trip(miles=0.0, fare=50.0), True),
        (trip(miles=0.0, fare=50.01), False),
    ],
)
def test_quality_filter(spark, row, kept):
    assert silver.quality_filter(trips(spark, row)).count() == int(kept)


def test_measures_are_null_without_duration_or_distance(spark):
    df = silver.trip_measures(
        trips(spark, trip(minutes=0), trip(minutes=-5), trip(miles=0.0), trip(minutes=6, miles=5.0), trip(minutes=1, miles=60.0))
    )
    got = [tuple(r) for r in df.select("trip_duration_minutes", "speed_mph", "fare_per_mile", "fare_per_minute").collect()]
    assert got[0] == (None, None, 5.0, None)
    assert got[1] == (None, None, 5.0, None)
    assert got[2] == (10.0, None, None, 1.0)
    assert got[3] == (6.0, 50.0, 2.0, 10.0 / 6.0)
    assert got[4][1] == 120.0


def test_bands_and_weekend(spark):
    hours = spark.range(24).select(F.col("id").alias("h"), rides.part_of_day(F.col("id")).alias("part"))
    parts = {r["h"]: r["part"] for r in hours.collect()}
    assert [parts[h] for h in (4, 5, 11, 12, 16, 17, 20, 21)] == [
        "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night",
    ]
    calendar = silver.calendar_columns(trips(spark, trip(start=dt.datetime(2024, 1, 14)), trip(start=None)))
    assert rows_of(calendar, "day_of_week", "is_weekend", "time_of_day") == [(1, True, "night"), (None, False, "night")]


def test_newest_copy_decides_even_if_it_is_then_dropped(spark):
    early, late = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    df = trips(spark, trip(), trip(fare=-1.0), trip(pu=9)).withColumn(
        "ingestion_timestamp",
        F.when(F.col("fare_amount") < 0, F.lit(late)).when(F.col("PULocationID") == 9, F.lit(None)).otherwise(F.lit(early)),
    )
    assert rows_of(silver.silver_table(df), "PULocationID") == [(9,)]


def test_merge_key_skips_nulls_unless_told_otherwise(spark):
    df = trips(spark, trip(pu=None, do=7), trip(pu=7, do=None))
    assert silver.build_merge_key(df).select("merge_key").distinct().count() == 1
    assert silver.build_merge_key(df, null_safe=True).select("merge_key").distinct().count() == 2


def test_many_copies_shuffle_one_row_per_task(spark):
    copies = spark.range(20_000).select(
        F.when(F.col("id") >= 0, "k").alias("merge_key"),
        (F.lit(NOON) + F.make_dt_interval(mins=(F.col("id") % 2).cast("int"))).alias("ingestion_timestamp"),
        F.col("id"),
    )
    single = silver.dedupe_latest(copies)
    assert rows_of(single, "id") == [(1,)]
    plan = plan_of(single)
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_peak_hour_tie_takes_the_earliest_in_both_forms(spark):
    df = silver.calendar_columns(trips(spark, *[trip(start=NOON.replace(hour=h)) for h in (15, 9, 15, 9, 20)]))
    assert rows_of(gold.peak_hour(df), "peak_hour") == [(9,)]
    measured = silver.trip_measures(df)
    assert rows_of(gold.daily_stats(measured), "peak_hour", "trip_count") == [(9, 5)]


def test_daily_stats_of_unknown_dates(spark):
    df = silver.trip_measures(silver.calendar_columns(trips(spark, trip(start=None), trip())))
    assert rows_of(gold.daily_stats(df), "trip_date", "trip_count", "avg_duration", "peak_hour") == [
        (None, 1, None, None), (NOON.date(), 1, 10.0, 12),
    ]


def test_zone_layouts(spark):
    df = trips(spark, trip(), trip(pu=None))
    assert rows_of(gold.zone_stats(df), "PULocationID", "trip_count") == [(5, 1), (None, 1)]
    unlocated = df.drop("PULocationID")
    assert gold.zone_stats(unlocated) is None
    assert rows_of(silver.geo_bucket(unlocated), "geo_bucket_id") == [(None,), (None,)]
    assert gold.zone_stats(silver.geo_bucket(unlocated)).count() == 0


def test_date_range_prunes_partitions_and_pushes_the_filter(spark, folder):
    df = trips(spark, *[trip(start=dt.datetime(2024, m, 10)) for m in range(1, 7)])
    sinks.sink_partitioned(bronze.partition_columns(df), folder)
    ranged = bronze.date_range_filter(tables.scan_table(spark, folder), "2024-03-01", "2024-05-01")
    assert rows_of(ranged, "month") == [(3,), (4,)]
    plan = plan_of(ranged)
    assert "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan


def test_text_timestamps(spark):
    df = trips(spark, trip()).withColumn("tpep_pickup_datetime", F.lit("2024-03-05T10:00:00"))
    broken = df.withColumn("tpep_pickup_datetime", F.lit("soon"))
    assert rows_of(bronze.partition_columns(df), "year", "month") == [(2024, 3)]
    assert rows_of(bronze.partition_columns(broken), "year", "month") == [(None, None)]
    assert bronze.date_range_filter(df, "2024-03-05", "2024-03-06").count() == 1


def test_nothing_is_written_for_no_rows(spark, folder):
    empty = bronze.partition_columns(trips(spark, trip())).filter("fare_amount < 0")
    assert not sinks.sink_partitioned(empty, folder)
    assert not sinks.table_exists(spark, folder)


def test_medallion_jobs(spark, folder):
    raw, lake = f"{folder}/raw", f"{folder}/lake"
    trips(spark, trip(), trip(), trip(pu=8), trip(fare=-1.0, pu=9)).write.parquet(raw)
    assert medallion.run_bronze(spark, raw, f"{lake}/bronze", processing_date="2024-02-01") == {"bronze": 4}
    expected = {"bronze": 4, "deduped": 3, "cleaned": 2}
    assert medallion.run_silver(spark, f"{lake}/bronze", f"{lake}/silver") == expected
    assert medallion.run_silver(spark, f"{lake}/bronze", f"{lake}/silver") == expected
    assert tables.scan_table(spark, f"{lake}/silver").count() == 2
    written = medallion.run_gold(spark, f"{lake}/silver", f"{lake}/gold")
    assert written == {name: True for name in ("hourly_stats", "daily_stats", "zone_stats", "driver_patterns")}
    assert medallion.run_gold(spark, f"{lake}/silver", f"{lake}/gold", start="2030-01-01") == {}
    hourly = tables.scan_table(spark, f"{lake}/gold/nyc_taxi/hourly_stats")
    assert rows_of(hourly, "hour_of_day", "trip_count") == [(12, 2)]
    assert medallion.run_bronze(spark, raw, f"{lake}/bronze", start="2030-01-01") == {"bronze": 0}
    source = tables.scan_table(spark, f"{lake}/bronze").select("source_file").first()[0]
    assert source.endswith(".parquet")


def test_few_copies_are_deduplicated_alone(spark):
    """The rows of dedupe_latest, and rows of keys that come once stay where they are."""
    once = [(f"k{i}", 1, float(i)) for i in range(500)]
    several = [*[("hot", i % 7, float(i)) for i in range(90)], ("k3", 2, 0.5), ("k3", None, 9.5), (None, 1, 1.0), (None, 3, 2.0)]
    rows = spark.createDataFrame([*once, *several], "merge_key string, delivery int, v double").repartition(5)
    found = silver.dedupe_few_copies(rows, newest="delivery")
    assert rows_of(found) == rows_of(silver.dedupe_latest(rows, newest="delivery"))
    assert rows_of(silver.dedupe_few_copies(rows.filter("v > 400"), newest="delivery")) == rows_of(rows.filter("v > 400"))
    kept = rows.withColumn("_at", F.spark_partition_id())
    again = silver.dedupe_few_copies(kept, newest="delivery").withColumn("_now", F.spark_partition_id())
    assert again.filter("_at = _now").count() >= 400
