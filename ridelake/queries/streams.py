"""Streaming queries, run to the end of a replayed table and compared with the table operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridelake.functions.ridejson import JSON_TIMES
from ridelake.plans import stream_jobs
from ridelake.queries.events import FLAGGED, METRICS, SESSION, SESSION_GLOBAL, SLIDING, TUMBLING
from ridelake.queries.registry import RIDES, register, settle
from ridelake.session import scratch_path
from ridelake.sources.replay import iso_text
from ridelake.sources.sample_shapes import prediction_events, rides
from ridelake.streaming import anomalies, predictions, sinks
from ridelake.streaming import rides as streaming


def ride_texts(events):
    """Ride events as JSON text."""
    event = F.struct(
        "ride_id",
        "vendor_id",
        iso_text(events.schema, "pickup_ts").alias("pickup_datetime"),
        iso_text(events.schema, "dropoff_ts").alias("dropoff_datetime"),
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "pickup_location_id",
        F.concat("pickup_location_id", F.lit("x")).alias("dropoff_location_id"),
    )
    return events.select(F.to_json(event).alias("value"))


def replayed(spark, sf) -> str:
    path = scratch_path(spark, "replay")
    ride_texts(rides(spark, sf)).write.text(path)
    return path


def halves(spark, sf):
    """Rides up to the middle of the time they span, and the others."""
    events = rides(spark, sf)
    span = events.agg(F.min("pickup_ts").alias("first"), F.max("pickup_ts").alias("last")).first()
    half = F.lit(span["first"] + (span["last"] - span["first"]) // 2).cast("timestamp_ntz")
    return ride_texts(events.filter(F.col("pickup_ts") <= half)), ride_texts(events.filter(F.col("pickup_ts") > half))


def own_session(spark):
    return streaming.stream_session(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))


def finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def zoneless(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _complete(spark, df):
    """The last state of a query in complete mode, which also holds windows still open."""
    target = scratch_path(spark, "complete")
    finish(sinks.sink_fanout(df, [sinks.batch_folder(target)], scratch_path(spark, "checkpoint"), None, "complete"))
    batches = spark.read.parquet(target)
    return batches.filter(F.col("batch") == batches.agg(F.max("batch")).scalar()).drop("batch")


def _metric_table(spark, sf, kind):
    events = streaming.ride_stream(own_session(spark), replayed(spark, sf))
    made = _complete(spark, streaming.METRIC_KINDS[kind](events))
    return settle(zoneless(made, "window_start", "window_end"), *METRICS)


@register(f"WITH {RIDES} {TUMBLING}")
def stream_tumbling_5m(spark, sf):
    return _metric_table(spark, sf, "tumbling_5m")


@register(f"WITH {RIDES} {SLIDING}")
def stream_sliding_15m_5m(spark, sf):
    return _metric_table(spark, sf, "sliding_15m_5m")


@register(f"WITH {RIDES} {SESSION}")
def stream_session_30m(spark, sf):
    return _metric_table(spark, sf, "session_30m")


def _closed(spark, sf, lateness: int):
    """Windows closed when both halves have been read one after the other; later ones stay open."""
    own = own_session(spark)
    source, target, checkpoint = (scratch_path(spark, x) for x in ("replay", "metrics", "checkpoint"))
    for part in halves(spark, sf):
        part.write.mode("append").text(source)
        events = streaming.ride_stream(own, source, lateness_seconds=lateness)
        finish(sinks.sink_stream_parquet(streaming.tumbling_metrics(events), target, checkpoint, None))
    return settle(zoneless(spark.read.parquet(target), "window_start", "window_end"), *METRICS)


def _closed_sql(delay: int) -> str:
    return (
        f"WITH {RIDES} SELECT * FROM ({TUMBLING}) "
        f"WHERE window_end <= (SELECT max(pickup_ts) FROM rides) - INTERVAL '{delay}' SECOND"
    )


@register(_closed_sql(10))
def event_time_watermark(spark, sf):
    return _closed(spark, sf, 0)


@register(_closed_sql(1810))
def event_time_watermark_lateness(spark, sf):
    return _closed(spark, sf, 1800)


@register(
    f"""WITH later AS (SELECT * FROM events WHERE ts > (SELECT make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2) FROM events)),
    {RIDES.replace('FROM events', 'FROM later')} SELECT * FROM ({TUMBLING})
    WHERE window_end <= (SELECT max(pickup_ts) FROM rides) - INTERVAL '10' SECOND"""
)
def late_data(spark, sf):
    """The halves in reverse: the first half then lies before the watermark and is dropped."""
    own = own_session(spark)
    source, target, checkpoint = (scratch_path(spark, x) for x in ("replay", "metrics", "checkpoint"))
    for part in reversed(halves(spark, sf)):
        part.write.mode("append").text(source)
        metrics = streaming.tumbling_metrics(streaming.ride_stream(own, source))
        finish(sinks.sink_stream_parquet(metrics, target, checkpoint, None))
    return settle(zoneless(spark.read.parquet(target), "window_start", "window_end"), *METRICS)


_CLOSED_KINDS = f"""SELECT * FROM ({TUMBLING} UNION ALL {SLIDING} UNION ALL {SESSION})
    WHERE window_end <= (SELECT max(pickup_ts) FROM rides) - INTERVAL '10' SECOND"""
_METRIC_SCHEMA = (
    "metric_type string, window_start timestamp, window_end timestamp, ride_count bigint, avg_fare double, total_revenue double, "
    "avg_distance double, pickup_location_id string"
)


@register(f"WITH {RIDES} SELECT sink, m.* FROM ({_CLOSED_KINDS}) m, (SELECT unnest(['json', 'parquet']) AS sink)")
def stream_unified_window_metrics(spark, sf):
    """Three kinds of windows into two sinks, stopped after the first half and resumed from the checkpoint."""
    own = own_session(spark)
    source, texts, files, checkpoint = (scratch_path(spark, x) for x in ("replay", "texts", "files", "checkpoint"))
    for part in halves(spark, sf):
        part.write.mode("append").text(source)
        finish(stream_jobs.run_metrics(own, source, texts, files, checkpoint, None))
    return settle(zoneless(_both_sinks(spark, texts, files, _METRIC_SCHEMA), "window_start", "window_end"), *METRICS)


_LAST_BUCKET = """(SELECT max(b) FROM (SELECT time_bucket(INTERVAL '30' MINUTE, pickup_ts) + INTERVAL '30' MINUTE AS b FROM rides)
    WHERE b <= (SELECT max(pickup_ts) FROM rides) - INTERVAL '10' SECOND)"""


@register(f"WITH {RIDES} SELECT * FROM ({SESSION_GLOBAL}) WHERE window_end < {_LAST_BUCKET}")
def stream_session_global(spark, sf):
    """Sessions over all rides that are over, after a stop in the middle; those that later rides may join are held back."""
    own = own_session(spark)
    source, target, state, checkpoint = (scratch_path(spark, x) for x in ("replay", "sessions", "waiting", "checkpoint"))
    for part in halves(spark, sf):
        part.write.mode("append").text(source)
        finish(stream_jobs.run_global_sessions(own, source, target, state, checkpoint, None))
    return settle(zoneless(stream_jobs.committed(spark, target, _METRIC_SCHEMA), "window_start", "window_end"), *METRICS)


def _both_sinks(spark, texts, files, schema):
    """Rows of a JSON and a Parquet sink, each named."""
    both = [
        stream_jobs.committed(spark, target, schema, fmt).withColumn("sink", F.lit(fmt))
        for target, fmt in ((texts, "json"), (files, "parquet"))
    ]
    return both[0].unionByName(both[1])


_EVENT = "SELECT ride_id, vendor_id, passenger_count, trip_distance, fare_amount, pickup_location_id, pickup_location_id || 'x' AS dropoff_location_id, pickup_ts, dropoff_ts FROM rides"
_EVENT_SCHEMA = (
    "ride_id string, vendor_id string, passenger_count int, trip_distance double, fare_amount double, "
    "pickup_location_id string, dropoff_location_id string, pickup_ts timestamp, dropoff_ts timestamp"
)


def _parsed(spark, sf):
    """Every field of the events, times to the microsecond."""
    events = streaming.ride_stream(own_session(spark), replayed(spark, sf))
    fields = ("ride_id", "vendor_id", "passenger_count", "trip_distance", "fare_amount", "pickup_location_id", "dropoff_location_id", "pickup_ts")
    return events.select(*fields, F.try_to_timestamp("dropoff_datetime").cast("timestamp").alias("dropoff_ts"))


@register(f"WITH {RIDES} {_EVENT}")
def source_stream_json(spark, sf):
    target = scratch_path(spark, "events")
    finish(sinks.sink_stream_parquet(_parsed(spark, sf), target, scratch_path(spark, "checkpoint"), None))
    return zoneless(spark.read.parquet(target), "pickup_ts", "dropoff_ts")


@register(f"WITH {RIDES} {_EVENT}")
def sink_stream_parquet(spark, sf):
    """At most 1000 rows a file, so that files roll."""
    target = scratch_path(spark, "events")
    finish(sinks.sink_stream_parquet(_parsed(spark, sf), target, scratch_path(spark, "checkpoint"), None, 1000))
    return zoneless(spark.read.parquet(target), "pickup_ts", "dropoff_ts")


@register(f"WITH {RIDES} {_EVENT}")
def sink_stream_json(spark, sf):
    target = scratch_path(spark, "texts")
    finish(sinks.sink_stream_json(_parsed(spark, sf), target, scratch_path(spark, "checkpoint"), None))
    read = spark.read.schema(_EVENT_SCHEMA).options(**JSON_TIMES).json(target)
    return zoneless(read, "pickup_ts", "dropoff_ts")


@register(f"WITH {RIDES} SELECT s.sink, e.* FROM ({_EVENT}) e, (SELECT unnest(['json', 'parquet']) AS sink) s")
def sink_fanout(spark, sf):
    target = scratch_path(spark, "fanout")
    writers = [sinks.batch_folder(f"{target}/{fmt}", fmt) for fmt in ("json", "parquet")]
    finish(sinks.sink_fanout(_parsed(spark, sf), writers, scratch_path(spark, "checkpoint"), None))
    return zoneless(_both_sinks(spark, f"{target}/json", f"{target}/parquet", _EVENT_SCHEMA), "pickup_ts", "dropoff_ts")


@register(f"WITH {RIDES}, {FLAGGED} SELECT ride_id, vendor_id, fare_amount, trip_distance, passenger_count, pickup_location_id, reasons FROM flagged")
def ride_anomalies_microbatch(spark, sf):
    """The query is stopped after the first half and resumed from its checkpoint for the second."""
    own = own_session(spark)
    source, target, state, checkpoint = (scratch_path(spark, x) for x in ("replay", "anomalies", "totals", "checkpoint"))
    for part in halves(spark, sf):
        part.write.mode("append").text(source)
        finish(anomalies.anomaly_batches(streaming.raw_stream(own, source), target, state, checkpoint, None))
    found = spark.read.parquet(f"{target}/batch=*").withColumn("reasons", F.array_join("reasons", ","))
    return found.drop("pickup_datetime", "dropoff_datetime")


_RECORDS = f"""WITH {RIDES}, {FLAGGED} SELECT ride_id, vendor_id, pickup_location_id, fare_amount, trip_distance, passenger_count,
    reasons, pickup_ts, dropoff_ts FROM flagged"""
_RECORD_SCHEMA = (
    "ride_id string, vendor_id string, pickup_location_id string, fare_amount double, trip_distance double, passenger_count int, "
    "reasons array<string>, pickup_datetime string, dropoff_datetime string"
)


def _shown(records):
    """Records of anomalies with typed times."""
    times = {f"{name}_ts": F.try_to_timestamp(f"{name}_datetime").cast("timestamp") for name in ("pickup", "dropoff")}
    typed = records.withColumns(times).withColumn("reasons", F.array_join("reasons", ","))
    return zoneless(typed.drop("pickup_datetime", "dropoff_datetime"), "pickup_ts", "dropoff_ts")


# A vendor's rides of a part are put in order in one task.
RIDES_PER_PART = 4_000_000


def _in_order(spark, sf, rides_per_part: int = RIDES_PER_PART):
    """Texts of the rides in at least three parts, each of later rides than the one before."""
    events = rides(spark, sf)
    seconds = F.unix_timestamp("pickup_ts")
    span = events.agg(F.min(seconds).alias("lo"), F.max(seconds).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    parts = max(3, -(-span.n // rides_per_part))
    part = F.floor((seconds - span.lo) * parts / (span.hi - span.lo + 1))
    return [ride_texts(events.filter(part == i)) for i in range(parts)]


@register(_RECORDS)
def ride_anomalies_stream(spark, sf):
    """State per vendor, over parts that arrive in the order of the rides."""
    own = own_session(spark)
    source, target, checkpoint = (scratch_path(spark, x) for x in ("replay", "anomalies", "checkpoint"))
    for part in _in_order(spark, sf):
        part.write.mode("append").text(source)
        payloads = anomalies.anomaly_payloads(anomalies.ride_anomalies_stream(streaming.raw_stream(own, source)))
        finish(sinks.sink_stream_parquet(payloads, target, checkpoint, None))
    read = spark.read.parquet(target).select(F.from_json("payload", _RECORD_SCHEMA).alias("r"))
    return _shown(read.select("r.*"))


@register(f"SELECT sink, r.* FROM ({_RECORDS}) r, (SELECT unnest(['json', 'parquet']) AS sink)")
def stream_anomalies_fanout(spark, sf):
    """The anomaly job with both its sinks."""
    own = own_session(spark)
    source, texts, files, checkpoint = (scratch_path(spark, x) for x in ("replay", "texts", "files", "checkpoint"))
    for part in _in_order(spark, sf):
        part.write.mode("append").text(source)
        finish(stream_jobs.run_anomalies(own, source, texts, files, checkpoint, None))
    return _shown(_both_sinks(spark, texts, files, _RECORD_SCHEMA))


LATENESS = 6 * 3600


@register(f"SELECT * FROM ({_RECORDS}) WHERE pickup_ts <= (SELECT max(ts) FROM events) - INTERVAL '{LATENESS}' SECOND")
def ride_anomalies_event_order(spark, sf):
    """Rides arrive up to five hours late and are scored in the order of their own time; the last six hours still wait."""
    own = own_session(spark)
    events = rides(spark, sf)
    arrival = F.unix_timestamp("pickup_ts") + F.pmod(F.xxhash64("ride_id"), F.lit(5 * 3600))
    span = events.agg(F.min(arrival).alias("lo"), F.max(arrival).alias("hi")).first()
    part = F.floor((arrival - span.lo) * 4 / (span.hi - span.lo + 1))
    source, target, state, checkpoint = (scratch_path(spark, x) for x in ("replay", "anomalies", "totals", "checkpoint"))
    for i in range(4):
        ride_texts(events.filter(part == i)).write.mode("append").text(source)
        finish(anomalies.anomaly_batches(streaming.raw_stream(own, source), target, state, checkpoint, None, LATENESS))
    return _shown(stream_jobs.committed(spark, target, _RECORD_SCHEMA))


@register(
    """SELECT CASE WHEN least(CAST(1 AS DOUBLE), value / 150) >= 0.85 THEN 'anomaly' ELSE 'normal' END AS result,
    count(*) AS events FROM events GROUP BY 1"""
)
def stream_prediction_event_flag(spark, sf):
    source = scratch_path(spark, "predictions")
    prediction_events(spark, sf).select("request_id", "prediction_score").write.parquet(source)
    events = own_session(spark).readStream.schema("request_id string, prediction_score double").parquet(source)
    return _complete(spark, predictions.prediction_counts(events))
