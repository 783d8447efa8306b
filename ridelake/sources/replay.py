"""A trip table turned into the stream of ride events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions.rides import resolve_columns


def iso_text(schema: T.StructType, name: str) -> Column:
    """ISO-8601 with offset; a time without zone is taken as UTC, text stays as it is."""
    kind, column = schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.TimestampType):
        column = F.to_utc_timestamp(column, F.current_timezone())
    seconds = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(column, "SSSSSS")
    dotted = F.when(fraction != "000000", F.concat(F.lit("."), fraction)).otherwise(F.lit(""))
    return F.concat(seconds, dotted, F.lit("+00:00"))


def replay_events(trips: DataFrame, ride_id: Column | None = None) -> DataFrame:
    """One compact JSON event per trip, whichever names its columns go by.

    Each event gets a new UUID unless ``ride_id`` gives one.
    """
    named = resolve_columns(trips)
    event = F.struct(
        (F.uuid() if ride_id is None else ride_id).alias("ride_id"),
        F.col("VendorID").cast("bigint").alias("vendor_id"),
        iso_text(named.schema, "tpep_pickup_datetime").alias("pickup_datetime"),
        iso_text(named.schema, "tpep_dropoff_datetime").alias("dropoff_datetime"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        F.col("PULocationID").cast("bigint").alias("pickup_location_id"),
        F.col("DOLocationID").cast("bigint").alias("dropoff_location_id"),
    )
    return named.select(F.to_json(event).alias("value"))
