"""Raw trips to the bronze layer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions.clock import typed_timestamp
from ridelake.functions.rides import NAME_VARIANTS, resolve_columns

# Columns a raw trip must have, and those it may have.
REQUIRED_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
)
OPTIONAL_COLUMNS = (
    "PULocationID",
    "DOLocationID",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
)

PICKUP = "tpep_pickup_datetime"


def validate_schema(
    df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, optional: Sequence[str] = OPTIONAL_COLUMNS
) -> list[str]:
    """Raise if a required column is missing; else name the optional ones present. Runs no job."""
    absent = sorted(set(required).difference(df.columns), key=list(required).index)
    if absent:
        raise ValueError(f"missing required columns {absent}; present are {sorted(df.columns)}")
    return [name for name in optional if name in df.columns]


def file_path_of(df: DataFrame) -> Column:
    """Path of the file a row was read from; empty where rows come from no file."""
    try:
        df.select("_metadata.file_path").schema  # noqa: B018 - resolves the name, runs no job
    except AnalysisException:
        return F.input_file_name()
    return F.col("_metadata.file_path")


def add_metadata(df: DataFrame, processing_date: str | date | None = None) -> DataFrame:
    """Ingestion time, source file and processing date (today unless given)."""
    day = F.current_date() if processing_date is None else F.lit(str(processing_date)).cast("date")
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file": file_path_of(df),
            "processing_date": day,
        }
    )


def add_batch_tags(df: DataFrame, source_system: str = "nyc_tlc_parquet") -> DataFrame:
    """Ingest time, source system and a row id that is unique within the batch."""
    return df.withColumns(
        {
            "ingest_ts": F.current_timestamp(),
            "source_system": F.lit(source_system),
            "batch_id": F.monotonically_increasing_id(),
        }
    )


def partition_columns(df: DataFrame, pickup: str = PICKUP) -> DataFrame:
    moment = typed_timestamp(df.schema, pickup)
    return df.withColumns({"year": F.year(moment), "month": F.month(moment)})


def months_between(start: str | date | None = None, end: str | date | None = None) -> Column | None:
    """The condition on ``year`` and ``month`` that ``start <= pickup < end`` implies; None without bounds."""
    year, month = F.col("year"), F.col("month")
    found = None
    for bound, later in ((start, True), (end, False)):
        if bound is not None:
            day = F.lit(str(bound)).cast("date")
            beyond = year > F.year(day) if later else year < F.year(day)
            same = month >= F.month(day) if later else month <= F.month(day)
            condition = beyond | ((year == F.year(day)) & same)
            found = condition if found is None else found & condition
    return found


def date_range_filter(
    df: DataFrame, start: str | date | None = None, end: str | date | None = None, pickup: str = PICKUP
) -> DataFrame:
    """Rows with ``start <= pickup < end``, either bound optional.

    The bound takes the column's own type, so the comparison reaches the Parquet scan.
    Where ``year`` and ``month`` exist, the months the range can touch are added as a
    predicate, which prunes whole partitions.
    """
    kind = df.schema[pickup].dataType
    moment = typed_timestamp(df.schema, pickup)
    target = T.TimestampType() if isinstance(kind, T.StringType) else kind
    if start is not None:
        df = df.filter(moment >= F.lit(str(start)).cast(target))
    if end is not None:
        df = df.filter(moment < F.lit(str(end)).cast(target))
    months = months_between(start, end)
    return df.filter(months) if months is not None and {"year", "month"} <= set(df.columns) else df


def bronze_table(
    raw: DataFrame,
    processing_date: str | date | None = None,
    start: str | date | None = None,
    end: str | date | None = None,
) -> DataFrame:
    """Validated raw trips with metadata and partition columns, within the date range.

    Columns may bear any of their known names, as in files of green cabs.
    """
    raw = resolve_columns(raw, optional=tuple(NAME_VARIANTS))
    validate_schema(raw)
    return (
        raw.transform(add_metadata, processing_date)
        .transform(partition_columns)
        .transform(date_range_filter, start, end)
    )
