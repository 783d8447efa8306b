"""Trips: bronze, silver and gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions import rides as rules
from ridelake.operators import bronze, gold, silver
from ridelake.operators.counting import StageCounts
from ridelake.plans.medallion import counted_silver
from ridelake.queries.registry import (
    DERIVED,
    HOUR,
    KEYED,
    LATEST,
    MINUTES,
    QUALITY,
    SILVER,
    TRIPS,
    VARIANT,
    WEEKDAY,
    avg,
    bands,
    register,
    settle,
    total,
)
from ridelake.sources.sample_shapes import located_trips, trips

RAW = (
    "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, fare_amount, "
    "total_amount, PULocationID, DOLocationID, delivery"
)
ADDED = (
    "trip_duration_minutes, speed_mph, fare_per_mile, fare_per_minute, hour_of_day, day_of_week, is_weekend, time_of_day"
)
AVERAGES = ("avg_fare", "avg_distance", "avg_duration", "avg_speed")


def silver_of(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_table(trips(spark, sf), newest="delivery")


def variant_of(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_variant(trips(spark, sf))


@register(f"WITH {TRIPS} SELECT {RAW} FROM trips")
def validate_schema(spark, sf):
    df = trips(spark, sf)
    bronze.validate_schema(df)
    return df


@register(
    f"WITH {TRIPS} SELECT {RAW}, CAST(year(tpep_pickup_datetime) AS INT) AS year, "
    "CAST(month(tpep_pickup_datetime) AS INT) AS month FROM trips"
)
def partition_columns(spark, sf):
    return bronze.partition_columns(trips(spark, sf))


@register(f"WITH {TRIPS} SELECT {RAW}, DATE '2024-02-01' AS processing_date FROM trips")
def add_metadata(spark, sf):
    tagged = bronze.add_metadata(trips(spark, sf), "2024-02-01")
    return tagged.drop("ingestion_timestamp", "source_file")


@register(f"WITH {TRIPS} SELECT {RAW}, 'nyc_tlc_parquet' AS source_system FROM trips")
def add_batch_tags(spark, sf):
    return bronze.add_batch_tags(trips(spark, sf)).drop("ingest_ts", "batch_id")


@register(
    f"WITH {TRIPS} SELECT {RAW} FROM trips WHERE tpep_pickup_datetime >= TIMESTAMP '1997-03-01 00:00:00' "
    "AND tpep_pickup_datetime < TIMESTAMP '1998-07-01 00:00:00'"
)
def date_range_filter(spark, sf):
    return bronze.date_range_filter(trips(spark, sf), "1997-03-01", "1998-07-01")


@register(f"WITH {TRIPS} SELECT {RAW} FROM trips WHERE {QUALITY}")
def quality_filter(spark, sf):
    return silver.quality_filter(trips(spark, sf))


@register(
    f"WITH {TRIPS} SELECT {RAW} FROM trips WHERE fare_amount >= 0 AND passenger_count > 0 AND trip_distance > 0"
)
def quality_filter_strict(spark, sf):
    return silver.quality_filter(trips(spark, sf), silver.STRICT_RULES)


@register(f"WITH {KEYED} SELECT {RAW}, merge_key FROM keyed")
def build_merge_key(spark, sf):
    return silver.build_merge_key(trips(spark, sf))


@register(
    f"""WITH {TRIPS} SELECT copies, count(*) AS keys FROM (
      SELECT count(*) AS copies FROM trips GROUP BY VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
      passenger_count, trip_distance, fare_amount, total_amount) GROUP BY copies"""
)
def build_merge_key_fallback(spark, sf):
    unlocated = trips(spark, sf).drop("PULocationID", "DOLocationID")
    sizes = silver.build_merge_key(unlocated).groupBy("merge_key").agg(F.count(F.lit(1)).alias("copies"))
    return sizes.groupBy("copies").agg(F.count(F.lit(1)).alias("keys"))


@register(f"WITH {LATEST} SELECT {RAW}, merge_key FROM latest")
def dedupe_latest(spark, sf):
    return silver.dedupe_latest(silver.build_merge_key(trips(spark, sf)), newest="delivery")


def _measured(spark, sf, *added):
    return silver.trip_measures(trips(spark, sf)).select(*map(str.strip, RAW.split(",")), *added)


_MEASURED = f"WITH {TRIPS}, m AS ({DERIVED} FROM (SELECT *, {MINUTES} AS trip_duration_minutes FROM trips)) SELECT {RAW}, "


@register(_MEASURED + "trip_duration_minutes FROM m")
def trip_duration(spark, sf):
    return _measured(spark, sf, "trip_duration_minutes")


@register(_MEASURED + "speed_mph FROM m")
def trip_speed(spark, sf):
    return _measured(spark, sf, "speed_mph")


@register(_MEASURED + "fare_per_mile, fare_per_minute FROM m")
def fare_ratios(spark, sf):
    return _measured(spark, sf, "fare_per_mile", "fare_per_minute")


@register(
    f"WITH {TRIPS} SELECT {RAW}, {HOUR} AS hour_of_day, {WEEKDAY} AS day_of_week, {WEEKDAY} IN (1, 7) AS is_weekend FROM trips"
)
def calendar_columns(spark, sf):
    return silver.calendar_columns(trips(spark, sf)).drop("time_of_day")


@register(f"WITH {TRIPS} SELECT {RAW}, {bands((5, 12, 17, 21))} AS time_of_day FROM trips")
def time_of_day(spark, sf):
    return trips(spark, sf).withColumn("time_of_day", rules.part_of_day(F.hour("tpep_pickup_datetime")))


@register(
    f"""WITH {VARIANT} SELECT {RAW}, trip_duration_sec, speed_mph, fare_per_mile, hour_of_day, day_of_week,
    is_weekend, time_of_day FROM variant"""
)
def silver_variant(spark, sf):
    return variant_of(spark, sf)


_LAT = "round(CAST(40.5 AS DOUBLE) + PULocationID / CAST(300 AS DOUBLE), 2)"
_LON = "round(CAST(-74.25 AS DOUBLE) + DOLocationID / CAST(300 AS DOUBLE), 2)"
_LOCATED = (
    f"WITH {TRIPS}, placed AS (SELECT *, {_LAT} AS pickup_lat_bucket, {_LON} AS pickup_lon_bucket, "
    f"concat_ws('_', CAST({_LAT} AS VARCHAR), CAST({_LON} AS VARCHAR)) AS geo_bucket_id FROM trips) "
)


@register(
    _LOCATED + "SELECT VendorID, tpep_pickup_datetime, fare_amount, pickup_lat_bucket, pickup_lon_bucket, geo_bucket_id FROM placed"
)
def geo_bucket(spark, sf):
    return silver.geo_bucket(located_trips(spark, sf)).select(
        "VendorID", "tpep_pickup_datetime", "fare_amount", "pickup_lat_bucket", "pickup_lon_bucket", "geo_bucket_id"
    )


@register(f"WITH {SILVER} SELECT {RAW}, merge_key, {ADDED} FROM silver")
def silver_table(spark, sf):
    return silver_of(spark, sf).drop("pickup_lat_bucket", "pickup_lon_bucket", "geo_bucket_id")


_BASE = ", ".join(
    [
        avg("fare_amount", "avg_fare"),
        avg("trip_distance", "avg_distance"),
        avg("trip_duration_minutes", "avg_duration"),
        "count(*) AS trip_count",
        avg("speed_mph", "avg_speed"),
        total("total_amount", "total_revenue"),
    ]
)


@register(f"WITH {SILVER} SELECT hour_of_day, {_BASE} FROM silver GROUP BY hour_of_day")
def hourly_stats(spark, sf):
    return settle(gold.hourly_stats(silver_of(spark, sf)), *AVERAGES, "total_revenue")


@register(
    f"""WITH {VARIANT} SELECT hour_of_day, count(*) AS trip_count, {avg('fare_amount', 'avg_fare')},
    {avg('trip_distance', 'avg_distance')}, {avg('trip_duration_sec', 'avg_duration')}, {avg('speed_mph', 'avg_speed')},
    {total('fare_amount', 'total_revenue')} FROM variant GROUP BY hour_of_day"""
)
def hourly_stats_variant(spark, sf):
    return settle(gold.hourly_stats_variant(variant_of(spark, sf)), *AVERAGES, "total_revenue")


_DATE = "CAST(tpep_pickup_datetime AS DATE)"


def _peak(source: str) -> str:
    return f"""peak AS (SELECT trip_date, hour_of_day AS peak_hour FROM (
      SELECT trip_date, hour_of_day, row_number() OVER (PARTITION BY trip_date ORDER BY n DESC, hour_of_day) AS place
      FROM (SELECT {_DATE} AS trip_date, hour_of_day, count(*) AS n FROM {source} GROUP BY 1, 2)) WHERE place = 1)"""


_DAILY = f"daily AS (SELECT {_DATE} AS trip_date, {_BASE}, {avg('passenger_count', 'avg_passenger_count')} FROM silver GROUP BY 1)"


@register(f"WITH {SILVER}, {_DAILY}, {_peak('silver')} SELECT * FROM daily LEFT JOIN peak USING (trip_date)")
def daily_stats(spark, sf):
    daily = gold.daily_stats(silver_of(spark, sf))
    return settle(daily, *AVERAGES, "avg_passenger_count", "total_revenue")


@register(f"WITH {SILVER}, {_DAILY}, {_peak('silver')} SELECT * FROM daily LEFT JOIN peak USING (trip_date)")
def join_daily_peak(spark, sf):
    rows = silver_of(spark, sf)
    measures = {**gold.BASE_MEASURES, "avg_passenger_count": "avg(passenger_count)"}
    daily = gold.rollup(gold.with_trip_date(rows), ["trip_date"], measures)
    joined = gold.join_daily_peak(daily, gold.peak_hour(rows))
    return settle(joined, *AVERAGES, "avg_passenger_count", "total_revenue")


_DAILY_VARIANT = f"""daily AS (SELECT {_DATE} AS trip_date, count(*) AS daily_trip_count,
    {avg('fare_amount', 'daily_avg_fare')}, {total('fare_amount', 'daily_total_revenue')} FROM variant GROUP BY 1)"""


def _daily_variant(spark, sf):
    return settle(gold.daily_stats_variant(variant_of(spark, sf)), "daily_avg_fare", "daily_total_revenue")


_DAILY_VARIANT_SQL = f"WITH {VARIANT}, {_DAILY_VARIANT}, {_peak('variant')} SELECT * FROM daily JOIN peak USING (trip_date)"


@register(_DAILY_VARIANT_SQL)
def daily_stats_variant(spark, sf):
    return _daily_variant(spark, sf)


@register(_DAILY_VARIANT_SQL)
def join_daily_peak_inner(spark, sf):
    return _daily_variant(spark, sf)


@register(f"WITH {SILVER}, {_peak('silver')} SELECT * FROM peak")
def peak_hour(spark, sf):
    return gold.peak_hour(silver_of(spark, sf))


@register(f"WITH {VARIANT}, {_peak('variant')} SELECT * FROM peak")
def peak_hour_variant(spark, sf):
    return gold.peak_hour(variant_of(spark, sf))


ZONE_AGGREGATES = ", ".join([avg("fare_amount", "avg_fare"), "count(*) AS trip_count", avg("trip_distance", "avg_distance")])


@register(f"WITH {SILVER} SELECT PULocationID, DOLocationID, {ZONE_AGGREGATES} FROM silver GROUP BY 1, 2")
def zone_pair_stats(spark, sf):
    return settle(gold.zone_stats(silver_of(spark, sf)), "avg_fare", "avg_distance")


_TRIP = "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, fare_amount, total_amount"


@register(
    _LOCATED.rstrip()
    + f""", latest AS (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY {_TRIP} ORDER BY delivery DESC, PULocationID, DOLocationID) = 1)
    SELECT geo_bucket_id, {ZONE_AGGREGATES} FROM latest WHERE {QUALITY} GROUP BY 1"""
)
def zone_geo_stats(spark, sf):
    """Trips that come with positions have no zones in their key."""
    latest = silver.dedupe_latest(silver.build_merge_key(located_trips(spark, sf)), newest="delivery")
    placed = silver.geo_bucket(silver.quality_filter(latest))
    return settle(gold.zone_stats(placed), "avg_fare", "avg_distance")


@register(
    f"""WITH {VARIANT} SELECT PULocationID AS zone_id, {avg('fare_amount', 'zone_avg_fare')}, count(*) AS zone_trip_count,
    {avg('trip_distance', 'zone_avg_distance')} FROM variant GROUP BY 1"""
)
def zone_pickup_stats(spark, sf):
    return settle(gold.zone_pickup_stats(variant_of(spark, sf)), "zone_avg_fare", "zone_avg_distance")


@register(
    f"""WITH {SILVER} SELECT VendorID, day_of_week, count(*) AS trip_count, {total('total_amount', 'total_revenue')},
    {avg('trip_distance', 'avg_distance')}, {avg('fare_amount', 'avg_fare')} FROM silver GROUP BY 1, 2"""
)
def driver_patterns(spark, sf):
    return settle(gold.driver_patterns(silver_of(spark, sf)), "avg_distance", "avg_fare", "total_revenue")


_WEEKDAY_FARE = f"WITH {VARIANT} SELECT day_of_week, {avg('fare_amount', 'avg_fare')} FROM variant GROUP BY 1 ORDER BY 1"


@register(_WEEKDAY_FARE)
def weekday_fare(spark, sf):
    return settle(gold.weekday_fare(variant_of(spark, sf)), "avg_fare")


@register(_WEEKDAY_FARE)
def order_by(spark, sf):
    return settle(gold.rollup(variant_of(spark, sf), ["day_of_week"], {"avg_fare": "avg(fare_amount)"}), "avg_fare").orderBy(
        "day_of_week"
    )


@register(
    f"WITH {TRIPS} SELECT {RAW} FROM trips ORDER BY fare_amount DESC, tpep_pickup_datetime, PULocationID, DOLocationID, "
    "tpep_dropoff_datetime, delivery LIMIT 5"
)
def preview(spark, sf):
    order = ["tpep_pickup_datetime", "PULocationID", "DOLocationID", "tpep_dropoff_datetime", "delivery"]
    return trips(spark, sf).orderBy(F.desc("fare_amount"), *order).limit(5)


@register(
    f"""WITH {SILVER} SELECT 'bronze' AS stage, count(*) AS row_count FROM trips
    UNION ALL SELECT 'deduped', count(*) FROM latest UNION ALL SELECT 'cleaned', count(*) FROM cleaned"""
)
def stage_counts(spark, sf):
    counts = StageCounts()
    bronze_rows = counts.mark(trips(spark, sf), "bronze")
    counted_silver(bronze_rows, counts, newest="delivery").write.format("noop").mode("overwrite").save()
    return counts.table(spark)


@register(
    f"""WITH {SILVER} SELECT PULocationID AS location_id, {avg('fare_amount', 'zone_avg_fare')},
    count(*) AS zone_trip_count, {avg('trip_distance', 'zone_avg_distance')} FROM silver GROUP BY 1"""
)
def feature_rename(spark, sf):
    zones = gold.rollup(silver_of(spark, sf), ["PULocationID"], gold.ZONE_MEASURES)
    return settle(gold.feature_rename(zones, "zone"), "zone_avg_fare", "zone_avg_distance")


@register(
    """SELECT l_suppkey AS VendorID, l_shipdate AS tpep_pickup_datetime, l_shipdate + INTERVAL '1' HOUR AS
    tpep_dropoff_datetime, l_partkey AS PULocationID, l_suppkey AS DOLocationID FROM lineitem"""
)
def resolve_columns(spark, sf):
    green = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_suppkey").alias("vendor_id"),
        F.col("l_shipdate").alias("lpep_pickup_datetime"),
        (F.col("l_shipdate") + F.expr("INTERVAL '1' HOUR")).alias("lpep_dropoff_datetime"),
        F.col("l_partkey").alias("PULocationID"),
        F.col("l_suppkey").alias("dropoff_location_id"),
    )
    return rules.resolve_columns(green)
