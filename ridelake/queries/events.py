"""Rides: windows over event time, running statistics, anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridelake.functions import ridejson
from ridelake.functions.clock import epoch_seconds
from ridelake.operators import anomalies, windows
from ridelake.queries.registry import RIDES, avg, register, settle, settled, total
from ridelake.sources.replay import iso_text
from ridelake.sources.sample_shapes import prediction_events, rides
from ridelake.streaming import predictions

METRICS = ("avg_fare", "avg_distance", "total_revenue")
_FARES = f"count(*) AS ride_count, {avg('fare_amount', 'avg_fare')}, {total('fare_amount', 'total_revenue')}"
_MILES = avg("trip_distance", "avg_distance")

TUMBLING = f"""SELECT 'tumbling_5m' AS metric_type, time_bucket(INTERVAL '5' MINUTE, pickup_ts) AS window_start,
  time_bucket(INTERVAL '5' MINUTE, pickup_ts) + INTERVAL '5' MINUTE AS window_end, {_FARES},
  CAST(NULL AS DOUBLE) AS avg_distance, CAST(NULL AS VARCHAR) AS pickup_location_id FROM rides GROUP BY 2"""
SLIDING = f"""SELECT 'sliding_15m_5m' AS metric_type, w AS window_start, w + INTERVAL '15' MINUTE AS window_end,
  {_FARES}, {_MILES}, CAST(NULL AS VARCHAR) AS pickup_location_id
  FROM (SELECT *, time_bucket(INTERVAL '5' MINUTE, pickup_ts) - k * INTERVAL '5' MINUTE AS w
        FROM rides, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY w"""


def _sessions(keys: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""(SELECT *, sum(fresh) OVER ({part} ORDER BY pickup_ts, ride_id ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT *, CASE WHEN pickup_ts - lag(pickup_ts) OVER ({part} ORDER BY pickup_ts, ride_id)
              <= INTERVAL '30' MINUTE THEN 0 ELSE 1 END AS fresh FROM rides))"""


SESSION = f"""SELECT 'session_30m_gap' AS metric_type, min(pickup_ts) AS window_start,
  max(pickup_ts) + INTERVAL '30' MINUTE AS window_end, {_FARES}, {_MILES}, pickup_location_id
  FROM {_sessions('pickup_location_id')} GROUP BY pickup_location_id, session"""
SESSION_GLOBAL = f"""SELECT 'session_30m_gap' AS metric_type, window_start, window_end, {_FARES}, {_MILES}, pickup_location_id
  FROM (SELECT *, min(pickup_ts) OVER (PARTITION BY session) AS window_start,
          max(pickup_ts) OVER (PARTITION BY session) + INTERVAL '30' MINUTE AS window_end FROM {_sessions('')})
  GROUP BY window_start, window_end, pickup_location_id"""


@register(f"WITH {RIDES} {TUMBLING}")
def tumbling_5m(spark, sf):
    return settle(windows.tumbling_5m(rides(spark, sf)), *METRICS)


@register(f"WITH {RIDES} {SLIDING}")
def sliding_15m_5m(spark, sf):
    return settle(windows.sliding_15m_5m(rides(spark, sf)), *METRICS)


@register(f"WITH {RIDES} {SESSION}")
def session_30m(spark, sf):
    return settle(windows.session_30m(rides(spark, sf)), *METRICS)


@register(f"WITH {RIDES} {SESSION_GLOBAL}")
def session_global(spark, sf):
    return settle(windows.session_global(rides(spark, sf)), *METRICS)


@register(f"WITH {RIDES} {TUMBLING} UNION ALL {SLIDING} UNION ALL {SESSION}")
def unified_window_metrics(spark, sf):
    return settle(windows.unified_window_metrics(rides(spark, sf)), *METRICS)


@register(
    f"""WITH {RIDES}, filled AS (SELECT time_bucket(INTERVAL '5' MINUTE, pickup_ts) AS window_start, count(fare_amount) AS n,
      sum(fare_amount) AS total FROM rides GROUP BY 1),
    calendar AS (SELECT unnest(generate_series((SELECT min(window_start) FROM filled), (SELECT max(window_start) FROM filled),
      INTERVAL '5' MINUTE)) AS window_start)
    SELECT window_start, coalesce(n, 0) AS ride_count, CAST(CAST(total / n AS FLOAT) AS DOUBLE) AS avg_value,
      CAST(CAST(coalesce(total, 0) AS FLOAT) AS DOUBLE) AS total_value FROM calendar LEFT JOIN filled USING (window_start)"""
)
def tumbling_gap_fill(spark, sf):
    return settle(windows.tumbling_gap_fill(rides(spark, sf)), "avg_value", "total_value")


@register(
    f"""WITH {RIDES} SELECT ride_id, pickup_ts, fare_amount, CAST(CAST(avg(fare_amount) OVER (ORDER BY pickup_ts
      RANGE BETWEEN INTERVAL '899.999999' SECOND PRECEDING AND CURRENT ROW) AS FLOAT) AS DOUBLE) AS rolling_mean FROM rides"""
)
def rolling_mean(spark, sf):
    smoothed = windows.rolling_mean(rides(spark, sf).select("ride_id", "pickup_ts", "fare_amount"), "fare_amount")
    return settle(smoothed, "rolling_mean")


PRIOR = f"""prior AS (SELECT *,
    coalesce(s / nullif(c, 0), 0) AS m,
    CASE WHEN c >= 2 THEN sqrt(greatest(0, q / c - (s / c) * (s / c))) ELSE 0 END AS sd
  FROM (SELECT *, count(*) OVER w AS c, coalesce(sum(fare_amount) OVER w, 0) AS s,
          coalesce(sum(fare_amount * fare_amount) OVER w, 0) AS q
        FROM rides WINDOW w AS (PARTITION BY vendor_id ORDER BY pickup_ts, ride_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))"""

# The rules as conditions on a ride and the statistics before it.
RULE_SQL = {
    "invalid_fare_or_passengers": "(fare_amount < 0 OR passenger_count <= 0)",
    "distance_over_100_miles": "(trip_distance > 100)",
    "fare_gt_3x_rolling_mean": "(c > 0 AND fare_amount > 3 * m)",
    "fare_gt_mean_plus_3std": "(c >= 2 AND sd > 1e-9 AND fare_amount > m + 3 * sd)",
    "speed_over_100_mph": "(dropoff_ts > pickup_ts AND trip_distance / "
    "(nullif(date_diff('microsecond', pickup_ts, dropoff_ts), 0) / 1000000.0 / 3600.0) > 100)",
}
REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{name}' END" for name, c in RULE_SQL.items()) + ")"
RIDE_COLUMNS = (
    "ride_id, vendor_id, pickup_ts, dropoff_ts, passenger_count, trip_distance, fare_amount, pickup_location_id"
)
FLAGGED = f"{PRIOR}, flagged AS (SELECT {RIDE_COLUMNS}, {REASONS} AS reasons FROM prior WHERE {' OR '.join(RULE_SQL.values())})"


@register(
    f"""WITH {RIDES}, {PRIOR} SELECT ride_id, vendor_id, c AS prior_count, {settled('m')} AS prior_mean,
    {settled('sd')} AS prior_std FROM prior"""
)
def running_vendor_stats(spark, sf):
    stats = anomalies.running_vendor_stats(rides(spark, sf))
    shown = stats.select("ride_id", "vendor_id", "prior_count", "prior_mean", "prior_std")
    return settle(shown, "prior_mean", "prior_std")


@register(f"WITH {RIDES}, {FLAGGED} SELECT * FROM flagged")
def ride_anomalies_batch(spark, sf):
    flagged = anomalies.ride_anomalies(rides(spark, sf))
    return flagged.withColumn("reasons", F.array_join("reasons", ","))


def _add_rule(rule: str) -> None:
    def query(spark, sf):
        return anomalies.rule_hits(rides(spark, sf), rule)

    query.__name__ = f"rule_{rule}"
    register(f"WITH {RIDES}, {PRIOR} SELECT {RIDE_COLUMNS} FROM prior WHERE {RULE_SQL[rule]}")(query)


for _rule in RULE_SQL:
    _add_rule(_rule)


@register(
    f"""WITH {RIDES}, {FLAGGED}, minutes AS (SELECT date_trunc('minute', pickup_ts) AS minute, count(*) AS n FROM flagged GROUP BY 1)
    SELECT w AS window_start, w + INTERVAL '5' MINUTE AS window_end, sum(n) / CAST(5 AS DOUBLE) AS anomalies_per_minute
    FROM (SELECT n, minute - k * INTERVAL '1' MINUTE AS w FROM minutes, (SELECT unnest([0, 1, 2, 3, 4]) AS k)) GROUP BY w"""
)
def anomalies_per_minute(spark, sf):
    return anomalies.anomalies_per_minute(anomalies.ride_anomalies(rides(spark, sf)))


@register(
    f"""WITH {RIDES} SELECT ride_id, fare_amount, CAST(CAST((fare_amount - mu) / sigma AS FLOAT) AS DOUBLE) AS z,
      abs((fare_amount - mu) / sigma) > 2.5 AS is_anomaly
    FROM rides, (SELECT avg(fare_amount) AS mu, CASE WHEN stddev_pop(fare_amount) = 0 THEN 1 ELSE stddev_pop(fare_amount) END
                 AS sigma FROM rides)"""
)
def zscore_flag(spark, sf):
    flagged = anomalies.zscore_flag(rides(spark, sf).select("ride_id", "fare_amount"), "fare_amount")
    return settle(flagged, "z")


@register(
    f"""WITH {RIDES}, m AS (SELECT avg(fare_amount) AS mu, stddev_pop(fare_amount) AS sigma FROM rides),
    f AS (SELECT fare_amount, abs((fare_amount - mu) / sigma) > 2.5 AS hit FROM rides, m)
    SELECT CAST(CAST(avg(CAST(hit AS INT)) AS FLOAT) AS DOUBLE) AS anomaly_rate, CAST(count(*) FILTER (hit) AS BIGINT) AS flagged,
      CAST(CAST(avg(fare_amount) FILTER (hit) AS FLOAT) AS DOUBLE) AS flagged_mean,
      CAST(CAST(stddev_samp(fare_amount) FILTER (hit) AS FLOAT) AS DOUBLE) AS flagged_std,
      min(fare_amount) FILTER (hit) AS flagged_min, max(fare_amount) FILTER (hit) AS flagged_max FROM f"""
)
def anomaly_rate(spark, sf):
    flagged = anomalies.zscore_flag(rides(spark, sf), "fare_amount")
    return settle(anomalies.anomaly_rate(flagged, "fare_amount"), "anomaly_rate", "flagged_mean", "flagged_std")


@register(f"""WITH {RIDES} SELECT ride_id, CASE WHEN CAST(ride_id AS BIGINT) % 3 = 0 THEN 'unknown' ELSE vendor_id END AS vendor_id FROM rides""")
def null_key(spark, sf):
    number = F.col("ride_id").cast("bigint")
    emptied = rides(spark, sf).withColumn(
        "vendor_id",
        F.when(number % 6 == 0, "").when(number % 3 == 0, F.lit(None)).otherwise(F.col("vendor_id")),
    )
    return anomalies.null_key(emptied).select("ride_id", "vendor_id")


@register(
    """SELECT CAST(event_id AS VARCHAR) AS ride_id, CAST(user_id AS VARCHAR) AS vendor_id,
      CAST(user_id % 7 AS INT) AS passenger_count, value AS fare_amount FROM events WHERE event_id % 5 <> 0"""
)
def parse_ride_json(spark, sf):
    """Every fifth text is broken in one of several ways and has to be dropped."""
    table = spark.read.parquet(f"{sf}/events.parquet")
    good = F.to_json(
        F.struct(
            F.col("event_id").alias("ride_id"),
            F.col("user_id").alias("vendor_id"),
            (F.col("user_id") % 7).alias("passenger_count"),
            F.col("value").alias("fare_amount"),
        )
    )
    which = (F.col("event_id") / 5).cast("bigint") % 4
    broken = (
        F.when(which == 0, F.substring(good, 2, 1000))
        .when(which == 1, F.lit('{"ride_id": "x", "fare_amount": "much"}'))
        .when(which == 2, F.lit('{"ride_id": null, "fare_amount": 1}'))
        .otherwise(F.lit("[1, 2]"))
    )
    texts = table.select(F.when(F.col("event_id") % 5 == 0, broken).otherwise(good).alias("value"))
    return ridejson.parse_ride_json(texts).select("ride_id", "vendor_id", "passenger_count", "fare_amount")


@register(
    "SELECT event_id, CASE event_id % 5 WHEN 3 THEN NULL ELSE CAST(epoch_us(date_trunc('second', ts)) AS DOUBLE) / 1e6 END AS event_time FROM events"
)
def parse_event_time(spark, sf):
    """Seconds, milliseconds, ISO with Z, rubbish, ISO with offset: the same instant each time."""
    table = spark.read.parquet(f"{sf}/events.parquet")
    seconds = F.unix_timestamp("ts")
    iso = F.substring(iso_text(table.schema, "ts"), 1, 19)
    form = F.col("event_id") % 5
    text = (
        F.when(form == 0, seconds.cast("string"))
        .when(form == 1, (seconds * 1000).cast("string"))
        .when(form == 2, F.concat(iso, F.lit("Z")))
        .when(form == 3, F.lit("not a time"))
        .otherwise(F.concat(iso, F.lit("+00:00")))
    )
    return table.select("event_id", epoch_seconds(text).alias("event_time"))


@register(
    """SELECT CASE WHEN least(CAST(1 AS DOUBLE), value / 150) >= 0.85 THEN 'anomaly' ELSE 'normal' END AS result,
    count(*) AS events FROM events GROUP BY 1"""
)
def prediction_event_flag(spark, sf):
    return predictions.prediction_counts(prediction_events(spark, sf))
