"""Where streams end: JSON, Parquet, or several sinks at once."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ridelake.functions.ridejson import JSON_TIMES, to_payload

# How often a checkpoint is taken, and when each output rolls to a new file.
CHECKPOINT_INTERVAL = "60 seconds"
METRICS_ROLL = "5 minutes"
ANOMALY_ROLL = "2 minutes"
ROWS_PER_FILE = 1_000_000


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Every interval, or, without one, everything there is and then stop."""
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)


def sink_stream_json(
    df: DataFrame, target: str, checkpoint: str, interval: str | None = CHECKPOINT_INTERVAL, options: Mapping[str, str] | None = None
) -> StreamingQuery:
    """Rows as JSON text: to a folder, or to a topic if ``target`` is ``kafka``."""
    texts = df.select(to_payload(alias="value"))
    fmt = "kafka" if target == "kafka" else "text"
    writer = texts.writeStream.format(fmt).outputMode("append").options(**(options or {}))
    writer = writer.option("checkpointLocation", checkpoint)
    if fmt == "text":
        writer = writer.option("path", target)
    return _triggered(writer, interval).start()


def sink_stream_parquet(
    df: DataFrame, target: str, checkpoint: str, interval: str | None = METRICS_ROLL, rows_per_file: int = ROWS_PER_FILE
) -> StreamingQuery:
    """Parquet files that roll with the trigger and at a row limit.

    The folder's ``_spark_metadata`` lists what is committed; readers go by it, which makes
    the sink exactly-once.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
    )
    return _triggered(writer, interval).start()


BatchWriter = Callable[[DataFrame, int], None]


def batch_folder(path: str, fmt: str = "parquet", mode: str = "overwrite") -> BatchWriter:
    """Writes each micro-batch to its own folder, so that a repeated batch replaces itself."""
    options = JSON_TIMES if fmt == "json" else {}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode(mode).format(fmt).options(**options).save(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def sink_fanout(
    df: DataFrame,
    writers: list[BatchWriter],
    checkpoint: str,
    interval: str | None = CHECKPOINT_INTERVAL,
    output_mode: str = "append",
) -> StreamingQuery:
    """One stream into several sinks: each micro-batch is computed once and handed to all."""

    def spread(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for write in writers:
                write(batch, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(spread)
    return _triggered(writer, interval).start()
