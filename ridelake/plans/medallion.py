"""The batch jobs: raw to bronze, bronze to silver, silver to gold. One write per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators import gold
from ridelake.operators.bronze import bronze_table, date_range_filter, months_between
from ridelake.operators.counting import StageCounts
from ridelake.operators.silver import (
    build_merge_key,
    calendar_columns,
    dedupe_latest,
    geo_bucket,
    quality_filter,
    trip_measures,
)
from ridelake.sources import table_log
from ridelake.sources.sinks import sink_gold, sink_partitioned
from ridelake.sources.tables import scan_parquet, scan_table


def run_bronze(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    start: str | None = None,
    end: str | None = None,
    processing_date: str | None = None,
    mode: str = "append",
) -> dict[str, int]:
    counts = StageCounts()
    bronze = bronze_table(scan_parquet(spark, raw_path), processing_date, start, end)
    written = sink_partitioned(bronze, bronze_path, mode, counts=counts, stage="bronze")
    return counts.get() if written else {"bronze": 0}


def counted_silver(bronze: DataFrame, counts: StageCounts, newest: str = "ingestion_timestamp") -> DataFrame:
    """Silver rows, counted after dedupe and after the filter."""
    deduped = counts.mark(bronze.transform(build_merge_key).transform(dedupe_latest, newest=newest), "deduped")
    cleaned = counts.mark(quality_filter(deduped), "cleaned")
    return cleaned.transform(trip_measures).transform(calendar_columns).transform(geo_bucket)


def run_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, start: str | None = None, end: str | None = None
) -> dict[str, int]:
    """Clean the bronze rows of the range and upsert them by merge key, as one new snapshot of the table."""
    counts = StageCounts()
    bronze = counts.mark(date_range_filter(scan_table(spark, bronze_path), start, end), "bronze")
    silver = counted_silver(bronze, counts).withColumn("silver_updated_at", F.current_timestamp())
    # The key holds the pickup time, which the partitions are made of.
    table_log.merge(silver, silver_path, ["merge_key"], keys_fix_partition=True)
    return counts.get()


def gold_tables(silver: DataFrame) -> dict[str, DataFrame | None]:
    return {
        "hourly_stats": gold.hourly_stats(silver),
        "daily_stats": gold.daily_stats(silver),
        "zone_stats": gold.zone_stats(silver),
        "driver_patterns": gold.driver_patterns(silver),
    }


def run_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    start: str | None = None,
    end: str | None = None,
    mode: str = "overwrite",
) -> dict[str, bool]:
    """Write the four gold tables; none, if the range holds no silver rows."""
    silver = date_range_filter(scan_table(spark, silver_path, within=months_between(start, end)), start, end)
    if silver.isEmpty():
        return {}
    stamped = {
        name: None if table is None else gold.stamped(table) for name, table in gold_tables(silver).items()
    }
    return sink_gold(stamped, f"{gold_path.rstrip('/')}/nyc_taxi", mode)
