"""Scans and sinks, exercised on the given tables through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridelake.operators import bronze, gold, silver
from ridelake.queries.batch import RAW, ZONE_AGGREGATES, silver_of
from ridelake.queries.registry import KEYED, SILVER, TRIPS, register, settle
from ridelake.session import scratch_path
from ridelake.sources import sinks, table_log, tables
from ridelake.sources.files import DATA_OPTIONS, PARTITIONS, spread_for_write
from ridelake.sources.replay import replay_events as to_events
from ridelake.sources.sample_shapes import table, trips

_MONTHS = "CAST(year(tpep_pickup_datetime) AS INT) AS year, CAST(month(tpep_pickup_datetime) AS INT) AS month"


@register("SELECT * FROM lineitem")
def scan_parquet(spark, sf):
    return tables.scan_parquet(spark, f"{sf}/lineitem.parquet")


@register(f"WITH {TRIPS} SELECT {RAW}, {_MONTHS} FROM trips")
def scan_table(spark, sf):
    path = scratch_path(spark, "table")
    sinks.sink_partitioned(bronze.partition_columns(trips(spark, sf)), path)
    return tables.scan_table(spark, path)


@register(
    f"WITH {TRIPS} SELECT {RAW}, {_MONTHS} FROM trips UNION ALL SELECT {RAW}, {_MONTHS} FROM trips WHERE delivery = 1"
)
def sink_partitioned(spark, sf):
    """Overwrite, append, and an empty append that writes nothing."""
    path, rows = scratch_path(spark, "partitioned"), bronze.partition_columns(trips(spark, sf))
    sinks.sink_partitioned(rows, path, "overwrite")
    sinks.sink_partitioned(rows.filter("delivery = 1"), path, "append")
    sinks.sink_partitioned(rows.filter("delivery > 1"), path, "append")
    return tables.scan_table(spark, path)


@register("SELECT * FROM events")
def scan_csv(spark, sf):
    path, events = scratch_path(spark, "csv"), table(spark, sf, "events")
    sinks.sink_csv(events, path)
    return tables.scan_csv(spark, path, events.schema)


@register(f"WITH {TRIPS} SELECT {RAW}, {_MONTHS} FROM trips")
def scan_parquet_partitioned(spark, sf):
    """Folders named by partition give their columns back."""
    path = scratch_path(spark, "parts")
    bronze.partition_columns(trips(spark, sf)).write.partitionBy("year", "month").parquet(path)
    return tables.scan_parquet(spark, path)


@register(f"WITH {SILVER} SELECT PULocationID, DOLocationID, {ZONE_AGGREGATES} FROM silver GROUP BY 1, 2")
def sink_gold(spark, sf):
    path, rows = scratch_path(spark, "gold"), silver_of(spark, sf)
    zones = settle(gold.zone_stats(rows), "avg_fare", "avg_distance")
    sinks.sink_gold({"zone_stats": zones, "no_table": None, "no_rows": zones.filter("trip_count < 0")}, path)
    return tables.scan_table(spark, f"{path}/zone_stats")


def _newest(spark, sf):
    """The newest of every trip with its key. Where keys are shuffled they are bytes, half as long as their text."""
    keyed = silver.build_merge_key(trips(spark, sf)).withColumn("merge_key", F.unhex("merge_key"))
    newest = silver.dedupe_few_copies(keyed, newest="delivery")
    return newest.withColumn("merge_key", F.lower(F.hex("merge_key")))


def _versions(spark, sf):
    """Old content and an update: every trip of the second delivery with a month later and double fare."""
    # Both read the trips that are in one of them, computed once.
    made, in_old, in_update = scratch_path(spark, "trips"), F.col("VendorID") == 1, F.col("delivery") == 1
    _newest(spark, sf).filter(in_old | in_update).write.options(**DATA_OPTIONS).parquet(made)
    keyed = spark.read.parquet(made)
    update = keyed.filter(in_update).withColumns(
        {
            "tpep_pickup_datetime": F.col("tpep_pickup_datetime") + F.expr("INTERVAL '31' DAY"),
            "fare_amount": F.col("fare_amount") * 2,
        }
    )
    return bronze.partition_columns(keyed.filter(in_old)), bronze.partition_columns(update)


_UPSERTED = f"""WITH {KEYED}, latest AS (SELECT * EXCLUDE (copy) FROM (SELECT *, row_number() OVER (PARTITION BY merge_key
    ORDER BY delivery DESC, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
      fare_amount, total_amount) AS copy FROM keyed) WHERE copy = 1),
  changed AS (SELECT * REPLACE (tpep_pickup_datetime + INTERVAL '31' DAY AS tpep_pickup_datetime, fare_amount * 2 AS fare_amount)
    FROM latest WHERE delivery = 1),
  merged AS (SELECT * FROM latest WHERE VendorID = 1 AND merge_key NOT IN (SELECT merge_key FROM changed)
    UNION ALL SELECT * FROM changed) SELECT {RAW}, merge_key, {_MONTHS} FROM merged"""


@register(_UPSERTED)
def upsert(spark, sf):
    """First load, then the same update twice: the second changes nothing."""
    path = scratch_path(spark, "upserted")
    old, update = _versions(spark, sf)
    for rows in (old, update, update):
        table_log.merge(rows, path, ["merge_key"])
    return tables.scan_table(spark, path)


@register(_UPSERTED)
def upsert_plain_folders(spark, sf):
    """The same into folders without a log, which any reader of Parquet understands."""
    path = scratch_path(spark, "upserted")
    old, update = _versions(spark, sf)
    for rows in (old, update):
        sinks.upsert(rows, path, ["merge_key"])
    return tables.scan_table(spark, path)


_ZONE_TEXT = "lpad(CAST((PULocationID + {shift}) % 12 AS VARCHAR), 2, '0')"


def _zone_name(shift: str) -> str:
    """Partition names that folder names could mistake: leading zeros, a colon, nothing at all, null."""
    text = _ZONE_TEXT.format(shift=shift)
    return f"CASE {text} WHEN '03' THEN 'a:b' WHEN '04' THEN '' WHEN '05' THEN NULL ELSE {text} END"


_TEXT_PARTITIONS = _UPSERTED.replace(
    f"SELECT {RAW}, merge_key, {_MONTHS} FROM merged",
    f"SELECT merge_key, fare_amount, {_zone_name('month(tpep_pickup_datetime)')} AS zone FROM merged",
)


@register(_TEXT_PARTITIONS)
def upsert_text_partition(spark, sf):
    """Partitions by text, which an update moves rows between."""
    path = scratch_path(spark, "text_partitions")
    zone = F.expr(_zone_name("month").replace("VARCHAR", "STRING")).alias("zone")
    for rows in _versions(spark, sf):
        table_log.merge(rows.select("merge_key", "fare_amount", zone), path, ["merge_key"], partitions=["zone"])
    return tables.scan_table(spark, path)


@register(
    f"""WITH {KEYED}, latest AS (SELECT * EXCLUDE (copy) FROM (SELECT *, row_number() OVER (PARTITION BY merge_key
    ORDER BY delivery DESC, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
      fare_amount, total_amount) AS copy FROM keyed) WHERE copy = 1)
    SELECT {RAW}, merge_key, {_MONTHS}, CASE WHEN delivery = 1 OR PULocationID % 2 = 0 THEN fare_amount * 2 END AS toll FROM latest"""
)
def upsert_evolving(spark, sf):
    """Three loads: without a column, with it for half of the zones, and with it for the second delivery."""
    path = scratch_path(spark, "evolving")
    rows = bronze.partition_columns(_newest(spark, sf))
    # The key follows from the row: it is made again where the rows have arrived. They are then read where they lie by partition.
    apart = silver.build_merge_key(spread_for_write(rows.drop("merge_key"), PARTITIONS)).select(*rows.columns)
    first = table_log.merge(apart, path, ["merge_key"], keys_fix_partition=True, lies_apart=True)
    tolled = table_log.read(spark, path, version=first).withColumn("toll", F.col("fare_amount") * 2)
    for load in (tolled.filter("PULocationID % 2 = 0"), tolled.filter("delivery = 1")):
        table_log.merge(load, path, ["merge_key"], keys_fix_partition=True, lies_apart=True)
    return tables.scan_table(spark, path)


@register(_UPSERTED)
def join_upsert(spark, sf):
    old, update = _versions(spark, sf)
    return sinks.changed_split(old, update, ["merge_key"])


_TRIP_KEY = "VendorID, tpep_pickup_datetime, PULocationID"


@register(
    f"""WITH {TRIPS} SELECT {RAW}, {_MONTHS} FROM (SELECT *, row_number() OVER (PARTITION BY {_TRIP_KEY} ORDER BY delivery DESC,
    tpep_dropoff_datetime, passenger_count, trip_distance, fare_amount, total_amount, DOLocationID) AS copy FROM trips) WHERE copy = 1"""
)
def upsert_composite(spark, sf):
    """Key of several columns: loads of both deliveries one after the other keep the newest row."""
    path = scratch_path(spark, "composite")
    rows = bronze.partition_columns(trips(spark, sf))
    for delivery in (0, 1):
        load = rows.filter(F.col("delivery") == delivery)
        table_log.merge(load, path, ["VendorID", "tpep_pickup_datetime", "PULocationID"], newest=["delivery"])
    return tables.scan_table(spark, path)


@register(
    """SELECT name AS name, is_partition FROM (VALUES ('VendorID', FALSE), ('fare_amount', FALSE), ('year', TRUE), ('month', TRUE))
    t(name, is_partition) WHERE (SELECT count(*) FROM lineitem) > 0"""
)
def table_detail(spark, sf):
    path, name = scratch_path(spark, "detail"), "ridelake_detail"
    rows = bronze.partition_columns(trips(spark, sf)).select("VendorID", "fare_amount", "year", "month")
    sinks.sink_partitioned(rows, path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} (VendorID BIGINT, fare_amount DOUBLE, year INT, month INT) USING parquet "
        f"PARTITIONED BY (year, month) LOCATION '{path}'"
    )
    return tables.table_detail(spark, name).select("name", "is_partition")


@register(
    """SELECT CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month,
      'yellow_tripdata_' || strftime(m, '%Y-%m') || '.parquet' AS file_name,
      'nyc-taxi/yellow_tripdata_' || strftime(m, '%Y-%m') || '.parquet' AS object_key
    FROM (SELECT unnest(generate_series(date_trunc('month', (SELECT min(l_shipdate) FROM lineitem)),
      date_trunc('month', (SELECT max(l_shipdate) FROM lineitem)), INTERVAL '1' MONTH)) AS m)"""
)
def month_range(spark, sf):
    bounds = table(spark, sf, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("first_day"), F.to_date(F.max("l_shipdate")).alias("last_day")
    )
    return tables.months_between(bounds)


@register(
    """SELECT 'nyc_tlc' AS source, 'yellow' AS trip_type, CAST(year(l_shipdate) AS INT) AS year,
      CAST(month(l_shipdate) AS INT) AS month, 'yellow_tripdata_' || strftime(l_shipdate, '%Y-%m') || '.parquet' AS file_name,
      TRUE AS holds_bytes FROM lineitem GROUP BY ALL"""
)
def ingest_manifest(spark, sf):
    """Files named as they are delivered, one for each month, then listed."""
    path = scratch_path(spark, "files")
    month = F.date_format("l_shipdate", "yyyy-MM")
    items = table(spark, sf, "lineitem").withColumn("m", month)
    items.repartition("m").write.partitionBy("m").parquet(f"{path}/parts")
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(f"{path}/raw"))
    for status in fs.globStatus(fs_path(f"{path}/parts/m=*/*.parquet")):
        name = status.getPath().getParent().getName().split("=")[1]
        if not fs.rename(status.getPath(), fs_path(f"{path}/raw/yellow_tripdata_{name}.parquet")):
            raise RuntimeError(f"more than one file for {name}")
    listed = tables.ingest_manifest(spark, f"{path}/raw")
    name = F.element_at(F.split("uri", "/"), -1).alias("file_name")
    return listed.select("source", "trip_type", "year", "month", name, (F.col("size_bytes") > 0).alias("holds_bytes"))


@register(
    f"""WITH {TRIPS} SELECT CAST(VendorID AS BIGINT) AS vendor_id, strftime(tpep_pickup_datetime, '%Y-%m-%dT%H:%M:%S+00:00') AS pickup_datetime,
    strftime(tpep_dropoff_datetime, '%Y-%m-%dT%H:%M:%S+00:00') AS dropoff_datetime, CAST(passenger_count AS INT) AS passenger_count,
    trip_distance, fare_amount, PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id FROM trips"""
)
def replay_events(spark, sf):
    """Events as JSON text, read back; the random ride id is left out."""
    schema = (
        "vendor_id bigint, pickup_datetime string, dropoff_datetime string, passenger_count int, trip_distance double, "
        "fare_amount double, pickup_location_id bigint, dropoff_location_id bigint"
    )
    return to_events(trips(spark, sf)).select(F.from_json("value", schema).alias("e")).select("e.*")


@register(
    """SELECT l_returnflag, o_orderpriority, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    GROUP BY 1, 2"""
)
def sql_access(spark, sf):
    sql = (
        "SELECT l_returnflag, o_orderpriority, count(*) AS n FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey "
        "GROUP BY 1, 2"
    )
    return tables.sql_access(spark, sql, {"lineitem": f"{sf}/lineitem.parquet", "orders": f"{sf}/orders.parquet"})
