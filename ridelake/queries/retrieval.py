"""Features: point-in-time joins, lookups, on-demand features, materialisation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ridelake.operators import features, gold, profiling
from ridelake.plans import feature_refresh
from ridelake.queries.batch import silver_of
from ridelake.queries.registry import ENTITIES, SILVER, avg, register, settle, total
from ridelake.session import scratch_path
from ridelake.sources.sample_shapes import entity_rows
from ridelake.sources.tables import scan_feature_source as open_source

_DAY_END = "CAST(CAST(tpep_pickup_datetime AS DATE) + 1 AS TIMESTAMP)"
ZONES = f"""zones AS (SELECT PULocationID AS location_id, {_DAY_END} AS event_timestamp, {avg('fare_amount', 'zone_avg_fare')},
    count(*) AS zone_trip_count, {avg('trip_distance', 'zone_avg_distance')} FROM silver GROUP BY 1, 2)"""
DAYS = f"""days AS (SELECT peak_hour AS hour_of_day, trip_date, CAST(trip_date + 1 AS TIMESTAMP) AS event_timestamp, daily_avg_fare,
    daily_trip_count, peak_hour, daily_total_revenue FROM
    (SELECT CAST(tpep_pickup_datetime AS DATE) AS trip_date, {avg('fare_amount', 'daily_avg_fare')}, count(*) AS daily_trip_count,
       {total('total_amount', 'daily_total_revenue')} FROM silver GROUP BY 1) JOIN
    (SELECT trip_date, CAST(hour_of_day AS BIGINT) AS peak_hour FROM (SELECT trip_date, hour_of_day,
       row_number() OVER (PARTITION BY trip_date ORDER BY n DESC, hour_of_day) AS place
       FROM (SELECT CAST(tpep_pickup_datetime AS DATE) AS trip_date, hour_of_day, count(*) AS n FROM silver GROUP BY 1, 2))
     WHERE place = 1) USING (trip_date))"""
NEWEST = "newest AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY event_timestamp DESC) AS n FROM zones) WHERE n = 1)"


def stored(spark, rows, view):
    """The view over its rows as a stored gold table, which is what views read."""
    path = scratch_path(spark, view.name)
    rows.write.parquet(path)
    return view.bind(lambda: open_source(spark, path, view.timestamp))


def zone_view(spark, sf, silver=None):
    rows = settle(gold.daily_zone_features(silver or silver_of(spark, sf)), "zone_avg_fare", "zone_avg_distance")
    return stored(spark, rows, features.ZONE_FEATURES)


def daily_view(spark, sf, silver=None):
    daily = gold.feature_rename(gold.daily_stats(silver or silver_of(spark, sf)), "daily")
    rows = settle(daily, "daily_avg_fare", "daily_total_revenue").select(
        F.col("peak_hour").alias("hour_of_day"),
        F.date_add("trip_date", 1).cast("timestamp_ntz").alias("event_timestamp"),
        *features.DAILY_TRIP_FEATURES.fields,
    )
    return stored(spark, rows, features.DAILY_TRIP_FEATURES)


ZONE_REFS = [f"zone_features:{name}" for name in features.ZONE_FEATURES.fields]
DAILY_REFS = [f"daily_trip_features:{name}" for name in features.DAILY_TRIP_FEATURES.fields]


def _held(name: str, ttl_days: int, prefix: str) -> str:
    held = f"f.event_timestamp >= e.event_timestamp - INTERVAL '{ttl_days}' DAY"
    return f"CASE WHEN {held} THEN f.{name} END AS {prefix}{name}"


@register(
    f"""WITH {SILVER}, {ZONES}, {ENTITIES} SELECT e.*, {', '.join(_held(c, 7, '') for c in features.ZONE_FEATURES.fields)}
    FROM entities e ASOF LEFT JOIN zones f ON e.location_id = f.location_id AND e.event_timestamp >= f.event_timestamp"""
)
def asof_join(spark, sf):
    view = zone_view(spark, sf)
    return features.asof_join(entity_rows(spark, sf), view.load(), "location_id", list(view.fields), view.ttl)


_TWO = f"""WITH {SILVER}, {ZONES}, {DAYS}, {ENTITIES},
    asked AS (SELECT *, entity_row_id % 24 AS hour_of_day FROM entities),
    one AS (SELECT e.*, {', '.join(_held(c, 7, 'zone_features__') for c in features.ZONE_FEATURES.fields)}
      FROM asked e ASOF LEFT JOIN zones f ON e.location_id = f.location_id AND e.event_timestamp >= f.event_timestamp)
    SELECT e.*, {', '.join(_held(c, 30, 'daily_trip_features__') for c in features.DAILY_TRIP_FEATURES.fields)}
      FROM one e ASOF LEFT JOIN days f ON e.hour_of_day = f.hour_of_day AND e.event_timestamp >= f.event_timestamp"""


def _two_views(spark, sf):
    asked = entity_rows(spark, sf).withColumn("hour_of_day", F.col("entity_row_id") % 24)
    path = scratch_path(spark, "silver")
    silver_of(spark, sf).write.parquet(path)
    silver = spark.read.parquet(path)
    views = [zone_view(spark, sf, silver), daily_view(spark, sf, silver)]
    return features.get_historical(asked, ZONE_REFS + DAILY_REFS, views)


@register(_TWO)
def multi_view_join(spark, sf):
    return _two_views(spark, sf)


@register(
    f"""WITH {SILVER}, {ZONES}, {ENTITIES} SELECT e.*, {', '.join(_held(c, 7, 'zone_features__') for c in features.ZONE_FEATURES.fields)}
    FROM entities e ASOF LEFT JOIN zones f ON e.location_id = f.location_id AND e.event_timestamp >= f.event_timestamp"""
)
def get_historical(spark, sf):
    return features.get_historical(entity_rows(spark, sf), ZONE_REFS, [zone_view(spark, sf)])


_LOOKUP = f"""WITH {SILVER}, {ZONES}, {NEWEST}, {ENTITIES}
    SELECT e.*, {', '.join(f'f.{c} AS zone_features__{c}' for c in features.ZONE_FEATURES.fields)}
    FROM entities e LEFT JOIN newest f ON e.location_id = f.location_id"""


@register(_LOOKUP)
def lookup_latest(spark, sf):
    return features.lookup_latest(entity_rows(spark, sf), ZONE_REFS, [zone_view(spark, sf)])


@register(_LOOKUP.replace("SELECT e.*,", "SELECT e.*, f.event_timestamp AS zone_features__event_timestamp,"))
def get_online(spark, sf):
    return features.lookup_latest(entity_rows(spark, sf), ZONE_REFS, [zone_view(spark, sf)], timestamps=True)


@register(
    f"""WITH {SILVER}, {ZONES}, {NEWEST}, {ENTITIES} SELECT e.*, f.zone_avg_fare, f.zone_trip_count, f.zone_avg_distance
    FROM entities e LEFT JOIN newest f ON e.location_id = f.location_id"""
)
def on_demand_join(spark, sf):
    refs, views = ZONE_REFS, [zone_view(spark, sf)]
    return features.lookup_latest(entity_rows(spark, sf), refs, views, full_names=False)


_RATIO = f"""WITH {SILVER}, {ZONES}, {NEWEST}, {ENTITIES}
    SELECT e.entity_row_id, e.location_id, e.fare_amount / nullif(f.zone_avg_fare, 0) AS expected_fare_ratio
    FROM entities e LEFT JOIN newest f ON e.location_id = f.location_id"""


def _ratio(spark, sf):
    made = features.on_demand(entity_rows(spark, sf), features.FARE_PREDICTION_FEATURES, zone_view(spark, sf))
    return made.select("entity_row_id", "location_id", "expected_fare_ratio")


@register(_RATIO)
def expected_fare_ratio(spark, sf):
    return _ratio(spark, sf)


@register(_RATIO)
def on_demand_feature(spark, sf):
    return _ratio(spark, sf)


def _newest_within(low: str, high: str) -> str:
    return f"""WITH {SILVER}, {ZONES} SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY location_id
      ORDER BY event_timestamp DESC) AS n FROM zones WHERE event_timestamp >= TIMESTAMP '{low}'
      AND event_timestamp <= TIMESTAMP '{high}') WHERE n = 1"""


@register(_newest_within("1998-01-01 00:00:00", "1998-03-01 00:00:00"))
def materialize(spark, sf):
    return features.materialize(zone_view(spark, sf), datetime(1998, 1, 1), datetime(1998, 3, 1))


@register(_newest_within("1998-02-22 00:00:00", "1998-06-01 00:00:00"))
def materialize_incremental(spark, sf):
    """Two runs: the first reaches back one TTL, the second only to the end of the first."""
    view, folder = zone_view(spark, sf), scratch_path(spark, "latest")
    for end in (datetime(1998, 3, 1), datetime(1998, 6, 1)):
        latest = feature_refresh.materialize_incremental(spark, view, end, folder)
    return latest


@register(
    f"""WITH {SILVER}, {ZONES} SELECT PULocationID AS location_id, event_timestamp, zone_avg_fare FROM
    (SELECT location_id AS PULocationID, event_timestamp, zone_avg_fare FROM zones)"""
)
def scan_feature_source(spark, sf):
    path = scratch_path(spark, "zones")
    zone_view(spark, sf).load().select(
        F.col("location_id").alias("zone_id"), F.col("event_timestamp").alias("as_of"), "zone_avg_fare"
    ).write.parquet(path)
    return open_source(spark, path, "event_timestamp", {"zone_id": "location_id", "as_of": "event_timestamp"})


@register(
    f"""WITH {SILVER}, {ZONES} SELECT max(event_timestamp) AS newest,
    max(event_timestamp) >= TIMESTAMP '2001-11-05 12:00:00' - INTERVAL '24' HOUR AS fresh FROM zones"""
)
def gold_freshness(spark, sf):
    as_of = F.lit("2001-11-05 12:00:00").cast("timestamp_ntz")
    return profiling.gold_freshness(zone_view(spark, sf).load(), as_of, "event_timestamp")


@register(
    f"""WITH {SILVER}, {ZONES} SELECT feature, violations, violations = 0 AS passed FROM (
    SELECT 'zone_avg_fare' AS feature, count(*) FILTER (zone_avg_fare < 5 OR zone_avg_fare > 90) AS violations FROM zones
    UNION ALL SELECT 'zone_avg_distance', count(*) FILTER (zone_avg_distance < 0) FROM zones)"""
)
def feature_range_check(spark, sf):
    bounds = {"zone_avg_fare": (5, 90), "zone_avg_distance": (0, None)}
    return profiling.feature_range_check(zone_view(spark, sf).load(), bounds)
