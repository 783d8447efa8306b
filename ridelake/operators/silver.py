"""Bronze to silver: key, dedupe, filter, derive — in this order.

Dedupe comes before the quality filter on purpose: the newest copy of a trip decides,
also when it is then filtered out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.functions import rides
from ridelake.functions.clock import seconds_between, typed_timestamp
from ridelake.operators.sizing import computed_once
from ridelake.sources.files import has_bit

# The conditions a trip has to meet; null in any of them drops the trip.
QUALITY_RULES = {
    "fare": "fare_amount >= 0",
    "total": "total_amount >= 0",
    "distance": "trip_distance >= 0",
    "passengers": "passenger_count > 0 AND passenger_count <= 6",
    "free_distance": "NOT (trip_distance = 0 AND fare_amount > 50)",
}
STRICT_RULES = {
    "fare": "fare_amount >= 0",
    "passengers": "passenger_count IS NOT NULL AND passenger_count > 0",
    "distance": "trip_distance > 0",
}

SPEED_CAP = 120.0


def build_merge_key(df: DataFrame, null_safe: bool = False) -> DataFrame:
    return df.withColumn("merge_key", rides.merge_key(df.columns, null_safe))


def dedupe_latest(
    df: DataFrame, keys: Sequence[str] = ("merge_key",), newest: str = "ingestion_timestamp"
) -> DataFrame:
    """One row per key: the newest, unknown times last, ties settled by all other columns.

    Spark keeps one row per key in every map task before it shuffles (``WindowGroupLimit``),
    so a key with very many copies sends one row per task.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in (*keys, newest)]
    order = Window.partitionBy(*keys).orderBy(F.col(newest).desc_nulls_last(), *rest)
    return df.withColumn("_copy", F.row_number().over(order)).filter("_copy = 1").drop("_copy")


def dedupe_few_copies(
    df: DataFrame, keys: Sequence[str] = ("merge_key",), newest: str = "ingestion_timestamp"
) -> DataFrame:
    """The rows of ``dedupe_latest``, for tables most of whose keys come once: rows of those are not shuffled.

    A first pass counts hashes of keys. Those that come more than once set bits, 32 MB of them at most; rows whose bit is
    set, be it by mistake, are deduplicated. The first pass runs at once.
    """
    hashed = F.xxhash64(*keys)
    again = computed_once(df.select(hashed.alias("_hash")).groupBy("_hash").count().filter("count > 1").select("_hash"))
    found = again.count()
    if not found:
        return df
    size = 1 << max(10, min(MOST_BITS, (16 * found).bit_length()))
    word, bit = F.shiftright("_at", 6).alias("word"), F.expr("shiftleft(1L, CAST(_at % 64 AS INT))").alias("bit")
    words = again.select(F.pmod("_hash", F.lit(size)).alias("_at")).select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    listed = words.agg(F.collect_list(F.struct("word", "bits")).alias("w"))
    bits = computed_once(listed.select(F.pandas_udf(_dense, "array<long>")(F.lit(size // 64), "w.word", "w.bits").alias("bits")))
    marked = df.withColumn("_again", has_bit(bits.scalar(), F.pmod(hashed, F.lit(size))))
    single, several = (marked.filter(c).drop("_again") for c in (~F.col("_again"), F.col("_again")))
    return single.unionByName(dedupe_latest(several, keys, newest))


# Two to this power is the most bits that are broadcast.
MOST_BITS = 28


def _dense(size: pd.Series, places: pd.Series, values: pd.Series) -> pd.Series:
    def fill(n: int, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        words = np.zeros(n, np.int64)
        words[at] = value
        return words

    return pd.Series([fill(*row) for row in zip(size, places, values)])


def all_rules(rules: Mapping[str, str]) -> Column:
    return reduce(Column.__and__, map(F.expr, rules.values()))


def quality_filter(df: DataFrame, rules: Mapping[str, str] = QUALITY_RULES) -> DataFrame:
    return df.filter(all_rules(rules))


def trip_measures(df: DataFrame, speed_cap: float | None = SPEED_CAP) -> DataFrame:
    """Duration, speed and fare ratios; null wherever duration or distance is not above zero."""
    start, end = (typed_timestamp(df.schema, f"tpep_{leg}_datetime") for leg in ("pickup", "dropoff"))
    distance = rides.positive("trip_distance")
    df = df.withColumn("trip_duration_minutes", rides.positive(seconds_between(start, end)) / F.lit(60.0))
    minutes = F.col("trip_duration_minutes")
    return df.withColumns(
        {
            "speed_mph": rides.capped(distance * F.lit(60.0) / minutes, speed_cap),
            "fare_per_mile": F.col("fare_amount") / distance,
            "fare_per_minute": F.col("fare_amount") / minutes,
        }
    )


def calendar_columns(df: DataFrame, bands: Mapping[str, tuple[int, int]] = rides.JOB_BANDS) -> DataFrame:
    moment = typed_timestamp(df.schema, "tpep_pickup_datetime")
    return df.withColumns({"hour_of_day": F.hour(moment), "day_of_week": F.dayofweek(moment)}).withColumns(
        {
            "is_weekend": rides.weekend(F.col("day_of_week")),
            "time_of_day": rides.part_of_day(F.col("hour_of_day"), bands),
        }
    )


def geo_bucket(df: DataFrame, digits: int = 2) -> DataFrame:
    """Pickup position on a grid of 0.01 degrees; typed nulls where no position is known."""
    lat, lon = "pickup_latitude", "pickup_longitude"
    if {lat, lon} <= set(df.columns):
        values = F.round(lat, digits), F.round(lon, digits), rides.grid_id(lat, lon, digits)
    else:
        values = F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("string")
    return df.withColumns(dict(zip(("pickup_lat_bucket", "pickup_lon_bucket", "geo_bucket_id"), values)))


def silver_table(
    bronze: DataFrame, newest: str = "ingestion_timestamp", null_safe_key: bool = False
) -> DataFrame:
    return (
        bronze.transform(build_merge_key, null_safe_key)
        .transform(dedupe_latest, newest=newest)
        .transform(quality_filter)
        .transform(trip_measures)
        .transform(calendar_columns)
        .transform(geo_bucket)
    )


def silver_variant(bronze: DataFrame) -> DataFrame:
    """The notebook form: strict filter, seconds, no speed cap, later band limits, no dedupe."""
    kept = quality_filter(bronze, STRICT_RULES)
    start, end = (typed_timestamp(kept.schema, f"tpep_{leg}_datetime") for leg in ("pickup", "dropoff"))
    timed = kept.withColumn("trip_duration_sec", seconds_between(start, end))
    hours = rides.positive("trip_duration_sec") / F.lit(3600.0)
    return timed.withColumns(
        {
            "speed_mph": F.col("trip_distance") / hours,
            "fare_per_mile": F.col("fare_amount") / F.col("trip_distance"),
        }
    ).transform(calendar_columns, rides.NOTEBOOK_BANDS)
