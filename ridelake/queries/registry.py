"""Where queries are registered, and the SQL text their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its oracle if SQL can express it."""

    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


# Aggregates of doubles depend on the order of addition in their last digits, and decimal
# rounding flips on averages that end in a 5. Query and oracle are compared in single precision
# there; values of single rows are compared as they are.


def settle(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("float").cast("double") for c in columns})


def settled(expr: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


def avg(expr: str, name: str) -> str:
    return f"{settled(f'avg({expr})')} AS {name}"


def total(expr: str, name: str) -> str:
    return f"{settled(f'sum({expr})')} AS {name}"


TRIPS = """trips AS (
  SELECT l_suppkey % 2 + 1 AS VendorID,
         l_shipdate + (l_partkey % 1440) * INTERVAL '1' MINUTE AS tpep_pickup_datetime,
         l_shipdate + (l_partkey % 1440) * INTERVAL '1' MINUTE
           + (CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS INT) END) * INTERVAL '1' MINUTE
           AS tpep_dropoff_datetime,
         l_partkey % 8 AS passenger_count,
         l_quantity * l_discount * 25 AS trip_distance,
         l_extendedprice / 1000 - 2 AS fare_amount,
         (l_extendedprice / 1000 - 2) * (1 + l_tax) AS total_amount,
         l_partkey % 263 + 1 AS PULocationID,
         l_suppkey % 263 + 1 AS DOLocationID,
         d.delivery AS delivery
  FROM lineitem
  JOIN (SELECT 0 AS delivery UNION ALL SELECT 1 AS delivery) d
    ON d.delivery = 0 OR l_orderkey % 10 = 0
)"""

KEYED = (
    TRIPS
    + """, keyed AS (
  SELECT *, sha256(concat_ws('|', CAST(VendorID AS VARCHAR), CAST(tpep_pickup_datetime AS VARCHAR),
           CAST(tpep_dropoff_datetime AS VARCHAR), CAST(PULocationID AS VARCHAR),
           CAST(DOLocationID AS VARCHAR))) AS merge_key
  FROM trips
)"""
)

LATEST = (
    KEYED
    + """, latest AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (
        PARTITION BY merge_key
        ORDER BY delivery DESC, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
                 trip_distance, fare_amount, total_amount, PULocationID, DOLocationID) AS copy
    FROM keyed) WHERE copy = 1
)"""
)

QUALITY = """fare_amount >= 0 AND total_amount >= 0 AND trip_distance >= 0
  AND passenger_count > 0 AND passenger_count <= 6 AND NOT (trip_distance = 0 AND fare_amount > 50)"""

DURATION = "date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime)"
MINUTES = f"CASE WHEN {DURATION} > 0 THEN {DURATION} / CAST(60 AS DOUBLE) END"
DISTANCE = "CASE WHEN trip_distance > 0 THEN trip_distance END"
RAW_SPEED = "(CASE WHEN trip_distance > 0 THEN trip_distance END) * CAST(60 AS DOUBLE) / trip_duration_minutes"
HOUR = "CAST(hour(tpep_pickup_datetime) AS INT)"
WEEKDAY = "CAST(dayofweek(tpep_pickup_datetime) + 1 AS INT)"


def bands(limits: tuple[int, int, int, int], hour: str = HOUR) -> str:
    a, b, c, d = limits
    return (
        f"CASE WHEN {hour} >= {a} AND {hour} < {b} THEN 'morning' WHEN {hour} >= {b} AND {hour} < {c} "
        f"THEN 'afternoon' WHEN {hour} >= {c} AND {hour} < {d} THEN 'evening' ELSE 'night' END"
    )


DERIVED = f"""SELECT *, CASE WHEN {RAW_SPEED} > 120 THEN 120 ELSE {RAW_SPEED} END AS speed_mph,
    fare_amount / ({DISTANCE}) AS fare_per_mile, fare_amount / trip_duration_minutes AS fare_per_minute,
    {HOUR} AS hour_of_day, {WEEKDAY} AS day_of_week, {WEEKDAY} IN (1, 7) AS is_weekend,
    {bands((5, 12, 17, 21))} AS time_of_day"""

SILVER = (
    LATEST
    + f""", cleaned AS (SELECT * FROM latest WHERE {QUALITY})
, silver AS ({DERIVED} FROM (SELECT *, {MINUTES} AS trip_duration_minutes FROM cleaned))"""
)

VARIANT = (
    TRIPS
    + f""", variant AS (
  SELECT *, CASE WHEN trip_duration_sec > 0 THEN trip_distance / (trip_duration_sec / CAST(3600 AS DOUBLE)) END
           AS speed_mph, fare_amount / trip_distance AS fare_per_mile,
         {HOUR} AS hour_of_day, {WEEKDAY} AS day_of_week, {WEEKDAY} IN (1, 7) AS is_weekend,
         {bands((6, 12, 17, 22))} AS time_of_day
  FROM (SELECT *, {DURATION} AS trip_duration_sec FROM trips
        WHERE fare_amount >= 0 AND passenger_count > 0 AND trip_distance > 0)
)"""
)

RIDES = """rides AS (
  SELECT CAST(event_id AS VARCHAR) AS ride_id, CAST(user_id % 5 AS VARCHAR) AS vendor_id, ts AS pickup_ts,
         ts + (event_id % 60) * INTERVAL '1' MINUTE AS dropoff_ts, CAST(user_id % 7 AS INT) AS passenger_count,
         value / 4 AS trip_distance, value - 1 AS fare_amount,
         CAST(user_id % 20 + 1 AS VARCHAR) AS pickup_location_id
  FROM events
)"""

ENTITIES = """entities AS (
  SELECT o_orderkey AS entity_row_id, o_custkey % 263 + 1 AS location_id, o_totalprice / 1000 AS fare_amount,
         o_orderdate AS event_timestamp
  FROM orders
)"""

VECTORS = """vectors AS (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS f0, CAST(embedding[2] AS DOUBLE) AS f1,
         CAST(embedding[3] AS DOUBLE) AS f2, CAST(embedding[4] AS DOUBLE) AS f3, label
  FROM embeddings
)"""

SCORED = """scored AS (
  SELECT *, CASE WHEN score < 0.45 THEN 0 WHEN score < 0.75 THEN 1 ELSE 2 END AS prediction,
         CASE WHEN third < 2.5 THEN 0 WHEN third < 5.0 THEN 1 ELSE 2 END AS label
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice / 10000 AS third,
               least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE),
                 (l_quantity / 10 * CAST(0.25 AS DOUBLE) + l_discount * 50 * CAST(0.15 AS DOUBLE)
                  + l_extendedprice / 10000 * CAST(0.35 AS DOUBLE) + l_tax * 30 * CAST(0.25 AS DOUBLE))
                 / CAST(10 AS DOUBLE))) AS score
        FROM lineitem)
)"""
