"""Tables that are computed once and read by several later steps."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh path in the shared folder and read back.

    A lost executor then costs the tasks that ran on it and not the steps before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside sends at most ``rows`` rows at once to Python; for rows of many kilobytes, which are held on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    most = int(before)
    spark.conf.set(name, str(min(most, rows) if most > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pieces(total: int, each: int) -> int:
    """How many groups of about ``each`` make up ``total``; at least one."""
    return max(1, -(-total // each))


def text_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column over all rows."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(column)).cast("long")), F.lit(0)).alias("n")).first().n
