"""Reading: Parquet, lakehouse tables, CSV, feature sources, file manifests, SQL access."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.sources import table_log


def scan_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, recursive: bool = False
) -> DataFrame:
    """A raw Parquet file, directory or glob; no columns is an error.

    Folders named ``column=value`` give columns. ``recursive`` reads all folders below, whatever
    their names, and so gives none.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    df = (reader.schema(schema) if schema is not None else reader).parquet(path)
    if not df.columns:
        raise RuntimeError(f"no data at {path}: empty schema")
    return df


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet", within: Column | None = None) -> DataFrame:
    """A lakehouse table by path; partition values come back as columns, and columns that later files added.

    A table with snapshots is read at its newest. ``within``, a condition on partition columns alone, prunes files of
    either kind.
    """
    if fmt == "parquet" and table_log.is_logged(spark, path):
        return table_log.read(spark, path, within)
    if within is not None:
        return scan_table(spark, path, fmt).filter(within)
    reader = spark.read.format(fmt)
    return (reader.option("mergeSchema", "true") if fmt in ("parquet", "orc") else reader).load(path)


# With the fraction in full: the default format would cut timestamps to milliseconds. Text comes back as
# it was: padded, empty (told from null by its quotes), with quotes, and over several lines.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    # A field without anything is null, one with empty quotes an empty text. The reader takes any text equal to its
    # null value for null, so that is one which no text file holds.
    return spark.read.schema(schema).options(**CSV_OPTIONS, nullValue="\0").csv(path)


def scan_feature_source(
    spark: SparkSession, path: str, timestamp: str, renames: Mapping[str, str] | None = None
) -> DataFrame:
    """A Parquet source of feature rows; the named column has to be a timestamp."""
    df = scan_table(spark, path).withColumnsRenamed(dict(renames or {}))
    kind = dict(df.dtypes).get(timestamp)
    if kind not in ("timestamp", "timestamp_ntz"):
        raise ValueError(f"{timestamp} is {kind or 'missing'}, not a timestamp")
    return df


def table_detail(spark: SparkSession, table: str) -> DataFrame:
    """Columns of a registered table, with their types and whether they partition it."""
    rows = [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(table)]
    return spark.createDataFrame(rows, "name string, data_type string, is_partition boolean")


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Make a table at a path known by name, for ad-hoc SQL."""
    spark.read.format(fmt).load(path).createOrReplaceTempView(name)


def sql_access(spark: SparkSession, sql: str, tables: Mapping[str, str | DataFrame]) -> DataFrame:
    """Ad-hoc SQL over tables given by path or as DataFrames."""
    frames = {
        name: scan_table(spark, source) if isinstance(source, str) else source for name, source in tables.items()
    }
    return spark.sql(sql, **frames)


def _month(text: str) -> date:
    if re.fullmatch(r"\s*[0-9]{4}-[0-9]{1,2}\s*", text) is None:
        raise ValueError(f"not a month as YYYY-MM: {text!r}")
    return datetime.strptime(text.strip(), "%Y-%m").date()


def months_between(bounds: DataFrame, trip_type: str = "yellow", prefix: str = "nyc-taxi") -> DataFrame:
    """Every month from ``first_day`` to ``last_day`` of each row, with its file name and key."""
    listed = bounds.select(
        F.explode(
            F.sequence(F.trunc("first_day", "month"), F.trunc("last_day", "month"), F.expr("INTERVAL 1 MONTH"))
        ).alias("month_start")
    )
    label = F.date_format("month_start", "yyyy-MM")
    file_name = F.concat(F.lit(f"{trip_type}_tripdata_"), label, F.lit(".parquet"))
    return listed.select(
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
        file_name.alias("file_name"),
        F.concat(F.lit(f"{prefix}/"), file_name).alias("object_key"),
    )


def month_range(spark: SparkSession, start: str, end: str, trip_type: str = "yellow") -> DataFrame:
    """Every month from start to end, both as YYYY-MM and inclusive; reversed bounds are an error."""
    first, last = _month(start), _month(end)
    if first > last:
        raise ValueError(f"{start} is after {end}")
    bounds = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    return months_between(bounds, trip_type)


def ingest_manifest(spark: SparkSession, path: str, source: str = "nyc_tlc") -> DataFrame:
    """One row per file below ``path``: source, trip type, year, month, uri, bytes.

    Trip type and month come from the file's name. Files are listed, not read.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = listed.select(
        F.col("path").alias("uri"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
    )
    pattern = r"^([a-z]+)_tripdata_([0-9]{4})-([0-9]{2})"

    def part(group: int):
        return F.nullif(F.regexp_extract("file_name", pattern, group), F.lit(""))

    return files.select(
        F.lit(source).alias("source"),
        part(1).alias("trip_type"),
        part(2).cast("int").alias("year"),
        part(3).cast("int").alias("month"),
        "uri",
        "size_bytes",
    )
