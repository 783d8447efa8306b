"""The streaming jobs: window metrics, and ride anomalies, each from one source into two sinks.

Every micro-batch goes to both sinks under its number, so a batch that is repeated after a failure replaces its own
output and no row comes twice. ``committed`` reads what such a sink holds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ridelake.functions.ridejson import JSON_TIMES
from ridelake.operators import windows
from ridelake.operators.sizing import computed_once
from ridelake.streaming import anomalies, rides, sinks


def unified_stream_metrics(events: DataFrame) -> DataFrame:
    """Tumbling, sliding and session metrics of a stream of rides as one stream of rows.

    Each kind has its own state; one watermark closes the windows of all three. A window is emitted once, when it is closed.
    """
    kinds = [metrics(events) for metrics in rides.METRIC_KINDS.values()]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def run_metrics(
    spark: SparkSession,
    source: str,
    json_target: str,
    parquet_target: str,
    checkpoint: str,
    interval: str | None = sinks.CHECKPOINT_INTERVAL,
    options: Mapping[str, str] | None = None,
    files_per_trigger: int | None = None,
    lateness_seconds: int = 0,
) -> StreamingQuery:
    """Start the metrics job; ``spark`` is a session from ``stream_session``. Without ``interval`` it ends with its source."""
    events = rides.ride_stream(spark, source, options, files_per_trigger, lateness_seconds)
    writers = [sinks.batch_folder(json_target, "json"), sinks.batch_folder(parquet_target)]
    return sinks.sink_fanout(unified_stream_metrics(events), writers, checkpoint, interval)


def run_anomalies(
    spark: SparkSession,
    source: str,
    json_target: str,
    parquet_target: str,
    checkpoint: str,
    interval: str | None = sinks.CHECKPOINT_INTERVAL,
    options: Mapping[str, str] | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the anomaly job: records as JSON text, and as Parquet."""
    raw = rides.raw_stream(spark, source, options, files_per_trigger)
    records = anomalies.ride_anomalies_stream(raw)
    writers = [sinks.batch_folder(json_target, "json"), sinks.batch_folder(parquet_target)]
    return sinks.sink_fanout(records, writers, checkpoint, interval)


def run_global_sessions(
    spark: SparkSession,
    source: str,
    target: str,
    state: str,
    checkpoint: str,
    interval: str | None = sinks.CHECKPOINT_INTERVAL,
    options: Mapping[str, str] | None = None,
    files_per_trigger: int | None = None,
    lateness_seconds: int = 0,
    gap_seconds: int = windows.GAP_SECONDS,
) -> StreamingQuery:
    """Start the job of sessions over all rides, which a session window, needing a key, cannot give.

    The stream sums rides up per bucket as wide as the gap; closed buckets are few, and no key or moment puts more into a task. Each
    micro-batch adds them to those that wait below ``state``, joins neighbours to sessions by the table operator, and writes
    the sessions that nothing later can reach. Like the target, what waits is kept per batch: a batch that is
    repeated starts from the one before.
    """
    base = state.rstrip("/")

    def close(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        waiting = batch if batch_id == 0 else batch.unionByName(own.read.parquet(f"{base}/batch={batch_id - 1}"))
        placed = computed_once(windows.global_sessions(computed_once(waiting), gap_seconds))
        # Buckets come in the order of time: one that is still to come begins where the last one ended, or later.
        reached = placed.agg(((F.max("bucket") + 1) * gap_seconds).alias("end")).first().end
        over = F.unix_micros("window_last") + F.lit(gap_seconds * 1_000_000) < F.lit((reached or 0) * 1_000_000)
        placed.filter(~over).select(batch.columns).write.mode("overwrite").parquet(f"{base}/batch={batch_id}")
        windows.global_metrics(placed.filter(over), gap_seconds).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={batch_id}")

    events = rides.ride_stream(spark, source, options, files_per_trigger, lateness_seconds)
    return sinks.sink_fanout(rides.bucket_sums(events, gap_seconds), [close], checkpoint, interval)


def committed(spark: SparkSession, target: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """Rows of all batches of a fan-out sink, without their numbers."""
    reader = spark.read.schema(schema).format(fmt).options(**(JSON_TIMES if fmt == "json" else {}))
    return reader.load(f"{target.rstrip('/')}/batch=*")
