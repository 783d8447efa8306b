"""The shapes the operators work on, derived from star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.scoring import rule_score


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _minutes(count: Column) -> Column:
    return F.make_dt_interval(mins=count.cast("int"))


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Raw trips from line items; every tenth order is delivered twice (``delivery`` 0 and 1)."""
    items = table(spark, folder, "lineitem")
    pickup = F.col("l_shipdate") + _minutes(F.col("l_partkey") % 1440)
    ride = F.when(F.col("l_linenumber") == 7, 0).otherwise(F.col("l_quantity").cast("int"))
    fare = F.col("l_extendedprice") / 1000 - 2
    copies = F.when(F.col("l_orderkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return items.select(
        (F.col("l_suppkey") % 2 + 1).alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        (pickup + _minutes(ride)).alias("tpep_dropoff_datetime"),
        (F.col("l_partkey") % 8).alias("passenger_count"),
        (F.col("l_quantity") * F.col("l_discount") * 25).alias("trip_distance"),
        fare.alias("fare_amount"),
        (fare * (1 + F.col("l_tax"))).alias("total_amount"),
        (F.col("l_partkey") % 263 + 1).alias("PULocationID"),
        (F.col("l_suppkey") % 263 + 1).alias("DOLocationID"),
        F.explode(copies).alias("delivery"),
    )


def located_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with positions in place of zones."""
    return (
        trips(spark, folder)
        .withColumn("pickup_latitude", F.lit(40.5) + F.col("PULocationID") / 300)
        .withColumn("pickup_longitude", F.lit(-74.25) + F.col("DOLocationID") / 300)
        .drop("PULocationID", "DOLocationID")
    )


def rides(spark: SparkSession, folder: str) -> DataFrame:
    """Ride events with typed timestamps."""
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("ride_id"),
        (F.col("user_id") % 5).cast("string").alias("vendor_id"),
        F.col("ts").alias("pickup_ts"),
        (F.col("ts") + _minutes(F.col("event_id") % 60)).alias("dropoff_ts"),
        (F.col("user_id") % 7).cast("int").alias("passenger_count"),
        (F.col("value") / 4).alias("trip_distance"),
        (F.col("value") - 1).alias("fare_amount"),
        (F.col("user_id") % 20 + 1).cast("string").alias("pickup_location_id"),
    )


def entity_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("entity_row_id"),
        (F.col("o_custkey") % 263 + 1).alias("location_id"),
        (F.col("o_totalprice") / 1000).alias("fare_amount"),
        F.col("o_orderdate").alias("event_timestamp"),
    )


# The four numeric features of the labelled vectors.
VECTOR_COLUMNS = ("f0", "f1", "f2", "f3")


def labelled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id",
        *[F.col("embedding")[i].cast("double").alias(name) for i, name in enumerate(VECTOR_COLUMNS)],
        F.col("label").cast("int").alias("label"),
    )


# Features of the labelled rides.
RIDE_FEATURES = ("passengers", "minutes", "miles", "fare")


def labelled_rides(spark: SparkSession, folder: str) -> DataFrame:
    """Rides with four features and a class that follows from the third, as ``rule_score`` sets it."""
    miles = F.col("value") / 20
    features = F.array((F.col("user_id") % 7).cast("double"), (F.col("event_id") % 60).cast("double"), miles, F.col("value") / 10)
    label, _ = rule_score(features)
    return table(spark, folder, "events").select(
        "event_id", *[features[i].alias(name) for i, name in enumerate(RIDE_FEATURES)], label.alias("label")
    )


def measured_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with four measures in the range the fixed scoring rules expect."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_returnflag",
        F.array(
            F.col("l_quantity") / 10,
            F.col("l_discount") * 50,
            F.col("l_extendedprice") / 10000,
            F.col("l_tax") * 30,
        ).alias("features"),
    )


def prediction_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("request_id"),
        F.col("ts").alias("timestamp"),
        F.least(F.lit(1.0), F.col("value") / 150).alias("prediction_score"),
    )
