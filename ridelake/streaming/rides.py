"""Ride events as a stream: source, event time, window metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.ridejson import read_ride_fields
from ridelake.operators.windows import GAP_SECONDS, SLIDE, SPAN, metric_rows, ride_sums
from ridelake.session import ROCKSDB_PROVIDER

WATERMARK_SECONDS = 10
SESSION_GAP = "30 minutes"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session on the same cluster with the state store the stateful queries need.

    Queries take their settings from the session they are built in; the caller's stays as
    it is. ``state_partitions`` is fixed for the life of a checkpoint.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    own.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    if state_partitions is not None:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def raw_stream(
    spark: SparkSession, source: str, options: Mapping[str, str] | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """JSON text, one event per row, in the column ``value``.

    ``source`` is a folder of text files, or ``kafka`` with the connector's options; a topic
    is read from its latest offset.
    """
    if source == "kafka":
        topic = {"startingOffsets": "latest", **(options or {})}
        return spark.readStream.format("kafka").options(**topic).load().select(F.col("value").cast("string"))
    reader = spark.readStream.format("text").options(**(options or {}))
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(source)


def event_time(df: DataFrame, text: str = "pickup_datetime", name: str = "pickup_ts") -> DataFrame:
    """Typed event time; a TIMESTAMP, as watermarks require. Events without one are dropped."""
    return df.withColumn(name, F.try_to_timestamp(text).cast("timestamp")).filter(F.col(name).isNotNull())


def event_time_watermark(df: DataFrame, lateness_seconds: int = 0, name: str = "pickup_ts") -> DataFrame:
    """Events may be ten seconds out of order, and ``lateness_seconds`` late on top of that."""
    return df.withWatermark(name, f"{WATERMARK_SECONDS + lateness_seconds} seconds")


def ride_stream(
    spark: SparkSession,
    source: str,
    options: Mapping[str, str] | None = None,
    files_per_trigger: int | None = None,
    lateness_seconds: int = 0,
) -> DataFrame:
    """Parsed ride events with event time and watermark; broken JSON is skipped."""
    raw = raw_stream(spark, source, options, files_per_trigger)
    return raw.transform(read_ride_fields).transform(event_time).transform(event_time_watermark, lateness_seconds)


def _windowed(rides: DataFrame, window: Column, *keys: str) -> DataFrame:
    return rides.groupBy(window.alias("w"), *keys).agg(*ride_sums())


def tumbling_metrics(rides: DataFrame) -> DataFrame:
    sums = _windowed(rides, F.window("pickup_ts", SLIDE))
    return metric_rows(sums, "tumbling_5m", F.col("w.start"), F.col("w.end"), distance=False)


def sliding_metrics(rides: DataFrame) -> DataFrame:
    sums = _windowed(rides, F.window("pickup_ts", SPAN, SLIDE))
    return metric_rows(sums, "sliding_15m_5m", F.col("w.start"), F.col("w.end"))


def session_metrics(rides: DataFrame) -> DataFrame:
    """Sessions per location. Sessions are merged in each task before the shuffle
    (see ``stream_session``), so a hot location shuffles sessions, not rides."""
    sums = _windowed(rides, F.session_window("pickup_ts", SESSION_GAP), "pickup_location_id")
    return metric_rows(sums, "session_30m_gap", F.col("w.start"), F.col("w.end"), location=True)


# The window kinds that share one sink, each a query of its own.
METRIC_KINDS = {"tumbling_5m": tumbling_metrics, "sliding_15m_5m": sliding_metrics, "session_30m": session_metrics}


def bucket_sums(rides: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Sums per location and gap-wide bucket of time, each once, when the watermark has passed it."""
    window = F.window("pickup_ts", f"{gap_seconds} seconds")
    ends = [F.min("pickup_ts").alias("first_ts"), F.max("pickup_ts").alias("last_ts")]
    sums = rides.groupBy(window.alias("w"), "pickup_location_id").agg(*ends, *ride_sums())
    bucket = F.floor(F.unix_timestamp("w.start") / F.lit(gap_seconds))
    return sums.withColumn("bucket", bucket).drop("w")
