"""Keeping the table of newest features up to date.

The latest table of a view has numbered snapshots (``sources/table_log.py``) and is cut into buckets by a hash of the key. A run
writes rows of the keys it has news of, and anew only the files of their buckets in which one of them is. How far the table has come
is part of its snapshot: both become visible at once, and a run that fails anywhere changes neither.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.features import FeatureView, materialize
from ridelake.sources import table_log

BUCKETS = 64
BUCKET = "_bucket"
# For those that still read the one before.
KEPT_VERSIONS = 2


def _path(view: FeatureView, folder: str) -> str:
    return f"{folder.rstrip('/')}/{view.name}"


def _publish(spark: SparkSession, view: FeatureView, rows: DataFrame, end: datetime, folder: str, replace: bool) -> DataFrame:
    path, key = _path(view, folder), view.entity.join_key
    before = table_log.snapshot(spark, path)
    # The number of buckets is one for the life of a table.
    buckets = before.notes["buckets"] if before is not None else BUCKETS
    placed = rows.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    notes = {"materialized_to": end.isoformat(), "buckets": buckets}
    table_log.merge(placed, path, [key], partitions=[BUCKET], keys_fix_partition=True, replace=replace, notes=notes)
    table_log.expire(spark, path, KEPT_VERSIONS)
    return latest_table(spark, view, folder)


def latest_table(spark: SparkSession, view: FeatureView, folder: str) -> DataFrame | None:
    """The current version of the view's latest table."""
    path = _path(view, folder)
    return table_log.read(spark, path).drop(BUCKET) if table_log.versions(spark, path) else None


def materialize_view(spark: SparkSession, view: FeatureView, start: datetime, end: datetime, folder: str) -> DataFrame:
    """Newest rows with a time in [start, end], as the latest table of the view."""
    return _publish(spark, view, materialize(view, start, end), end, folder, replace=True)


def materialized_to(spark: SparkSession, view: FeatureView, folder: str) -> datetime | None:
    of = table_log.snapshot(spark, _path(view, folder))
    return None if of is None else datetime.fromisoformat(of.notes["materialized_to"])


def materialize_incremental(spark: SparkSession, view: FeatureView, end: datetime, folder: str) -> DataFrame:
    """Merge rows since the last run into the latest table; at first, those one TTL back.

    What has a time from the end of the last run on is at least as new as what the table holds of its key, and takes
    its place.
    """
    start = materialized_to(spark, view, folder) or end - view.ttl
    return _publish(spark, view, materialize(view, start, end), end, folder, replace=False)
