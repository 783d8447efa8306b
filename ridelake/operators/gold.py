"""Silver to gold: one declared rollup per table.

A rollup names its keys and its measures as SQL expressions; grouping, column pruning and
partial aggregation are Spark's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.functions.clock import typed_timestamp

# Measures of the gold tables.
BASE_MEASURES = {
    "avg_fare": "avg(fare_amount)",
    "avg_distance": "avg(trip_distance)",
    "avg_duration": "avg(trip_duration_minutes)",
    "trip_count": "count(1)",
    "avg_speed": "avg(speed_mph)",
    "total_revenue": "sum(total_amount)",
}
VARIANT_MEASURES = {
    **BASE_MEASURES,
    "avg_duration": "avg(trip_duration_sec)",
    "total_revenue": "sum(fare_amount)",
}
ZONE_MEASURES = {name: BASE_MEASURES[name] for name in ("avg_fare", "trip_count", "avg_distance")}
VENDOR_MEASURES = {name: BASE_MEASURES[name] for name in ("trip_count", "total_revenue", "avg_distance", "avg_fare")}

# Columns averaged or summed by day, with the gold name of each.
DAILY_AVERAGES = {
    "avg_fare": "fare_amount",
    "avg_distance": "trip_distance",
    "avg_duration": "trip_duration_minutes",
    "avg_speed": "speed_mph",
    "avg_passenger_count": "passenger_count",
}

# Gold names and the feature names they are served under.
FEATURE_NAMES = {
    "zone": {
        "PULocationID": "location_id",
        "avg_fare": "zone_avg_fare",
        "trip_count": "zone_trip_count",
        "avg_distance": "zone_avg_distance",
    },
    "daily": {
        "avg_fare": "daily_avg_fare",
        "trip_count": "daily_trip_count",
        "total_revenue": "daily_total_revenue",
    },
}


def rollup(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(text).alias(name) for name, text in measures.items()])


def stamped(df: DataFrame, name: str = "gold_updated_at", at: datetime | None = None) -> DataFrame:
    return df.withColumn(name, F.current_timestamp() if at is None else F.lit(at))


def hourly_stats(silver: DataFrame) -> DataFrame:
    return rollup(silver, ["hour_of_day"], BASE_MEASURES)


def hourly_stats_variant(silver: DataFrame) -> DataFrame:
    return rollup(silver, ["hour_of_day"], VARIANT_MEASURES)


def with_trip_date(silver: DataFrame) -> DataFrame:
    return silver.withColumn("trip_date", F.to_date(typed_timestamp(silver.schema, "tpep_pickup_datetime")))


def daily_stats(silver: DataFrame) -> DataFrame:
    """Daily measures and the busiest hour from one pass over the trips.

    Trips are reduced to sums per date and hour; the days are merged from those few rows,
    so neither a second scan nor a join is needed.
    """
    parts = [F.count(F.lit(1)).alias("rides"), F.sum("total_amount").alias("revenue")]
    for name, column in DAILY_AVERAGES.items():
        parts += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    by_hour = with_trip_date(silver).groupBy("trip_date", "hour_of_day").agg(*parts)
    means = {
        name: F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(name) for name in DAILY_AVERAGES
    }
    return by_hour.groupBy("trip_date").agg(
        means["avg_fare"],
        means["avg_distance"],
        means["avg_duration"],
        F.sum("rides").alias("trip_count"),
        means["avg_speed"],
        F.sum("revenue").alias("total_revenue"),
        means["avg_passenger_count"],
        F.max_by("hour_of_day", F.struct("rides", -F.col("hour_of_day"))).alias("peak_hour"),
    )


def peak_hour(silver: DataFrame) -> DataFrame:
    """Busiest hour of each date; of equally busy ones the earliest."""
    counted = with_trip_date(silver).groupBy("trip_date", "hour_of_day").agg(F.count(F.lit(1)).alias("rides"))
    busiest = Window.partitionBy("trip_date").orderBy(F.desc("rides"), F.asc("hour_of_day"))
    return (
        counted.withColumn("place", F.row_number().over(busiest))
        .filter("place = 1")
        .select("trip_date", F.col("hour_of_day").alias("peak_hour"))
    )


def join_daily_peak(daily: DataFrame, peak: DataFrame, how: str = "left") -> DataFrame:
    """Daily aggregates with their peak hour; ``inner`` keeps only dates that have one."""
    return daily.join(peak, "trip_date", how)


def daily_stats_variant(silver: DataFrame) -> DataFrame:
    """Fare-based daily measures under ``daily_`` names, dates without a peak hour left out."""
    measures = {
        "daily_trip_count": "count(1)",
        "daily_avg_fare": "avg(fare_amount)",
        "daily_total_revenue": "sum(fare_amount)",
    }
    return join_daily_peak(rollup(with_trip_date(silver), ["trip_date"], measures), peak_hour(silver), "inner")


def zone_stats(silver: DataFrame) -> DataFrame | None:
    """By zone pair, else by grid cell, else no table at all."""
    if {"PULocationID", "DOLocationID"} <= set(silver.columns):
        return rollup(silver, ["PULocationID", "DOLocationID"], ZONE_MEASURES)
    if "geo_bucket_id" in silver.columns:
        return rollup(silver.filter("geo_bucket_id IS NOT NULL"), ["geo_bucket_id"], ZONE_MEASURES)
    return None


def zone_pickup_stats(silver: DataFrame) -> DataFrame:
    renamed = {FEATURE_NAMES["zone"][name]: text for name, text in ZONE_MEASURES.items()}
    return rollup(silver, ["PULocationID"], renamed).withColumnRenamed("PULocationID", "zone_id")


def driver_patterns(silver: DataFrame) -> DataFrame:
    return rollup(silver, ["VendorID", "day_of_week"], VENDOR_MEASURES)


def weekday_fare(silver: DataFrame) -> DataFrame:
    return rollup(silver, ["day_of_week"], {"avg_fare": "avg(fare_amount)"}).orderBy("day_of_week")


def feature_rename(df: DataFrame, layer: str) -> DataFrame:
    """Gold columns under the names the feature views declare."""
    return df.withColumnsRenamed(FEATURE_NAMES[layer])


def daily_zone_features(silver: DataFrame) -> DataFrame:
    """Zone features per day, valid from the day's end, so that no later ride leaks into them."""
    by_day = rollup(with_trip_date(silver), ["PULocationID", "trip_date"], ZONE_MEASURES)
    day_end = F.date_add("trip_date", 1).cast(silver.schema["tpep_pickup_datetime"].dataType)
    return feature_rename(by_day.withColumn("event_timestamp", day_end), "zone").drop("trip_date")
