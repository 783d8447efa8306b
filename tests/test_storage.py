from __future__ import annotations

import json
import os

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from ridelake.sources import sinks, table_log, tables
from ridelake.sources.files import refuse_repeated_keys
from ridelake.sources.replay import replay_events

ROWS = "k string, v int, year int, month int"


def content(spark, path):
    return rows_of(spark.read.parquet(path), "k", "v", "year", "month")


def test_upsert_updates_moves_and_inserts(spark, folder):
    first = [("a", 1, 2024, 1), ("b", 1, 2024, 1), ("c", 1, 2024, 2), ("d", 1, 2024, 3)]
    sinks.upsert(spark.createDataFrame(first, ROWS), folder, ["k"])
    update = spark.createDataFrame([("a", 2, 2024, 1), ("c", 2, 2024, 4), ("e", 2, 2024, 3)], ROWS)
    expected = [("a", 2, 2024, 1), ("b", 1, 2024, 1), ("c", 2, 2024, 4), ("d", 1, 2024, 3), ("e", 2, 2024, 3)]
    for _ in range(2):
        sinks.upsert(update, folder, ["k"])
        assert content(spark, folder) == expected
    assert not os.path.exists(f"{folder}/year=2024/month=2")


def test_upsert_leaves_other_partitions_alone(spark, folder):
    sinks.upsert(spark.createDataFrame([("a", 1, 2024, 1), ("b", 1, 2024, 2)], ROWS), folder, ["k"])
    before = sorted(os.listdir(f"{folder}/year=2024/month=2"))
    sinks.upsert(spark.createDataFrame([("a", 2, 2024, 1)], ROWS), folder, ["k"])
    assert sorted(os.listdir(f"{folder}/year=2024/month=2")) == before


def test_upsert_keeps_newest_copy_and_all_null_keys(spark, folder):
    rows = [("a", 1, 2024, 1), ("a", 3, 2024, 1), ("a", 2, 2024, 1), (None, 7, 2024, 1), (None, 8, 2024, 1)]
    sinks.upsert(spark.createDataFrame(rows, ROWS), folder, ["k"], newest=["v"])
    assert content(spark, folder) == sorted([("a", 3, 2024, 1), (None, 7, 2024, 1), (None, 8, 2024, 1)], key=repr)
    sinks.upsert(spark.createDataFrame([(None, 9, 2024, 1)], ROWS), folder, ["k"], newest=["v"])
    assert len(content(spark, folder)) == 4


def test_upsert_with_new_column_and_no_rows(spark, folder):
    sinks.upsert(spark.createDataFrame([("a", 1, 2024, 1), ("b", 1, 2024, 1)], ROWS), folder, ["k"])
    sinks.upsert(spark.createDataFrame([("a", 2, 2024, 1)], ROWS).filter("v > 5"), folder, ["k"])
    sinks.upsert(spark.createDataFrame([("a", 2, 2024, 1)], ROWS).withColumn("w", F.lit(5)), folder, ["k"])
    assert rows_of(spark.read.option("mergeSchema", True).parquet(folder), "k", "v", "w") == [("a", 2, 5), ("b", 1, None)]


def test_a_kept_row_keeps_its_new_column(spark, folder):
    sinks.upsert(spark.createDataFrame([("a", 1, 2024, 1)], ROWS), folder, ["k"])
    later = spark.createDataFrame([("b", 1, 2024, 2), ("c", 1, 2024, 2)], ROWS).withColumn("w", F.lit(5))
    sinks.upsert(later, folder, ["k"])
    sinks.upsert(later.filter("k = 'c'").withColumn("v", F.lit(9)), folder, ["k"])
    want = [("a", 1, None), ("b", 1, 5), ("c", 9, 5)]
    assert rows_of(tables.scan_table(spark, folder), "k", "v", "w") == want


def test_repeated_keys_are_refused_before_anything_is_written(spark, folder):
    sinks.upsert(spark.createDataFrame([("a", 1, 2024, 1)], ROWS), folder, ["k"])
    with pytest.raises(ValueError, match="more than once"):
        sinks.upsert(spark.createDataFrame([("b", 1, 2024, 1), ("b", 2, 2024, 2)], ROWS), folder, ["k"])
    assert rows_of(spark.read.parquet(folder), "k") == [("a",)]


def test_hundreds_of_partitions(spark, folder):
    rows = spark.range(400).selectExpr("cast(id as string) AS k", "1 AS v", "cast(2000 + id div 12 as int) AS year", "cast(id % 12 as int) AS month")
    sinks.upsert(rows, folder, ["k"])
    sinks.upsert(rows.withColumn("v", F.lit(2)), folder, ["k"], keys_fix_partition=True)
    assert tables.scan_table(spark, folder).groupBy("v").count().collect() == [(2, 400)]


def test_only_received_partitions_are_read(spark, folder):
    rows = spark.createDataFrame([("a", 1, 2024, 1), ("b", 1, 2024, 2), ("n", 1, None, None)], ROWS)
    sinks.upsert(rows, folder, ["k"])
    kept = spark.read.parquet(folder).filter(sinks._is_one_of({(2024, 1), (None, None)}, ("year", "month")))
    filters = plan_of(kept).partition("PartitionFilters: ")[2].partition("PushedFilters")[0]
    assert "IN ([2024,1],[null,null])" in filters and rows_of(kept, "k") == [("a",), ("n",)]


def test_an_interrupted_swap_is_finished(spark, folder, monkeypatch):
    sinks.upsert(spark.createDataFrame([("a", 1, 2024, 1), ("b", 1, 2024, 2)], ROWS), folder, ["k"])
    update = spark.createDataFrame([("a", 2, 2024, 3), ("c", 2, 2024, 2)], ROWS)
    done, finish = [], sinks.finish_upsert
    monkeypatch.setattr(sinks, "finish_upsert", lambda *a: finish(*a) if not done.append(1) and len(done) == 1 else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sinks.upsert(update, folder, ["k"])
    monkeypatch.undo()
    # Old rows are still there, and half a swap costs nothing: a partition is lost, then all is done again.
    assert rows_of(spark.read.parquet(folder), "k", "v") == [("a", 1), ("b", 1)]
    sinks.delete_folder(spark, f"{folder}/year=2024/month=2")
    assert sinks.finish_upsert(spark, folder) and not sinks.finish_upsert(spark, folder)
    assert rows_of(spark.read.parquet(folder), "k", "v", "month") == [("a", 2, 3), ("b", 1, 2), ("c", 2, 2)]
    assert not os.path.exists(f"{folder}/year=2024/month=1")


def test_csv_gives_text_back(spark, folder):
    texts = [(1, "  pad "), (2, "a\nb"), (3, ""), (4, None), (5, 'say "x", \\ y'), (6, "a,b"), (7, '""'), (8, "\t"), (9, '{"k": 69, "t": "u"}')]
    df = spark.createDataFrame(texts, "id int, text string")
    sinks.sink_csv(df, folder)
    assert rows_of(tables.scan_csv(spark, folder, df.schema)) == sorted(texts, key=repr)


def test_scan_parquet_keeps_partition_columns(spark, folder):
    spark.createDataFrame([("a", 1, 2024, 1)], ROWS).write.partitionBy("year", "month").parquet(f"{folder}/t")
    assert tables.scan_parquet(spark, f"{folder}/t").columns == ["k", "v", "year", "month"]
    assert tables.scan_parquet(spark, folder, recursive=True).columns == ["k", "v"]


def test_merge_into_names_the_way_out(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW plain AS SELECT 'a' AS k")
    with pytest.raises(NotImplementedError, match="upsert"):
        sinks.merge_into(spark, spark.createDataFrame([("a",)], "k string"), "plain", ["k"])


def test_gold_sink_skips_absent_and_empty(spark, folder):
    table = spark.range(3)
    written = sinks.sink_gold({"a": table, "b": None, "c": table.filter("id > 5")}, folder)
    assert written == {"a": True, "b": False, "c": False}
    assert os.listdir(folder) == ["a"]


def test_month_range(spark):
    months = tables.month_range(spark, "2023-11", "2024-02", "green")
    assert [tuple(r) for r in months.select("year", "month").collect()] == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    assert months.first()["object_key"] == "nyc-taxi/green_tripdata_2023-11.parquet"
    for bad in (("2024-13", "2024-14"), ("2024", "2025"), ("2024-02", "2024-01"), ("x-y", "2024-01")):
        with pytest.raises(ValueError):
            tables.month_range(spark, *bad)


def test_manifest_lists_size_and_path(spark, folder):
    spark.range(5).coalesce(1).write.parquet(folder)
    part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    os.mkdir(f"{folder}/named")
    named = f"{folder}/named/green_tripdata_2024-07.parquet"
    os.link(f"{folder}/{part}", named)
    row = tables.ingest_manifest(spark, f"{folder}/named").first()
    assert (row.trip_type, row.year, row.month, row.size_bytes) == ("green", 2024, 7, os.path.getsize(named))
    assert row.uri.endswith("green_tripdata_2024-07.parquet")


def test_feature_source_needs_a_timestamp(spark, folder):
    spark.range(2).select("id", F.lit("x").alias("t")).write.parquet(folder)
    with pytest.raises(ValueError, match="not a timestamp"):
        tables.scan_feature_source(spark, folder, "t")
    with pytest.raises(ValueError, match="missing"):
        tables.scan_feature_source(spark, folder, "when")


def test_events_are_compact_json_with_new_ids(spark):
    trips = spark.createDataFrame(
        [(1, "2024-01-15 08:30:00", "2024-01-15 08:45:00.25", 2, 3.5, 15.5, 161, 237)] * 2,
        "vendor_id int, a string, b string, passenger_count int, trip_distance double, fare_amount double, "
        "PULocationID int, DOLocationID int",
    ).select(
        "*", F.col("a").cast("timestamp_ntz").alias("lpep_pickup_datetime"), F.col("b").cast("timestamp_ntz").alias("lpep_dropoff_datetime")
    )
    first, second = [r[0] for r in replay_events(trips).collect()]
    event = json.loads(first)
    assert ": " not in first and event["ride_id"] != json.loads(second)["ride_id"]
    assert event["pickup_datetime"] == "2024-01-15T08:30:00+00:00"
    assert event["dropoff_datetime"] == "2024-01-15T08:45:00.250000+00:00"
    assert (event["vendor_id"], event["pickup_location_id"], event["passenger_count"]) == (1, 161, 2)


def test_repeated_keys_travel_as_hashes(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, n int")
    refuse_repeated_keys(rows, ["k", "n"])
    with pytest.raises(ValueError, match="more than once"):
        refuse_repeated_keys(rows, ["k"])


def test_files_of_a_table_keep_hexadecimal_keys_short(spark, folder):
    """A key of 64 hexadecimal digits holds 32 bytes and takes little more."""
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("merge_key"), F.lit(2024).alias("year"), F.lit(1).alias("month"))
    table_log.merge(rows, f"{folder}/logged")
    sinks.upsert(rows, f"{folder}/plain")
    for name in ("logged/data", "plain"):
        files = [f"{at}/{f}" for at, _, held in os.walk(f"{folder.removeprefix('file:')}/{name}") for f in held if f.endswith(".parquet")]
        assert 0 < sum(map(os.path.getsize, files)) < 20_000 * 50


def test_keys_of_another_integer_type_are_found(spark, folder):
    """A key that moves to another partition is found although the table holds it as a shorter integer."""
    sinks.upsert(spark.createDataFrame([(5, 1), (6, 1)], "k int, year int"), folder, ["k"], partitions=["year"])
    sinks.upsert(spark.createDataFrame([(5, 2)], "k bigint, year int"), folder, ["k"], partitions=["year"])
    files = [f"{at}/{f}" for at, _, held in os.walk(folder.removeprefix("file:")) for f in held if f.endswith(".parquet")]
    assert sorted((k, f.split("year=")[1][0]) for f in files for k in spark.read.parquet(f).toPandas()["k"]) == [(5, "2"), (6, "1")]


def test_rows_that_stay_in_plain_folders_are_not_shuffled(spark, folder, monkeypatch):
    spread, given = sinks.spread_for_write, []
    monkeypatch.setattr(sinks, "spread_for_write", lambda df, by: given.append(by) or spread(df, by))
    monkeypatch.setattr(sinks, "ROWS_AT_ONCE", 128, raising=False)
    held = {f"{i:04d}": (0, 2024, i % 6) for i in range(600)}
    update = {f"{i:04d}": (1, 2025, i % 5) for i in range(0, 660, 11)}
    nulls = [(None, i, 2024, 1) for i in range(3)]
    for rows in (held, update):
        sinks.upsert(spark.createDataFrame([*[(k, *v) for k, v in rows.items()], *nulls], ROWS), folder, ["k"])
    assert len(given) == 2  # what was received, twice
    assert content(spark, folder) == sorted([*[(k, *v) for k, v in (held | update).items()], *nulls, *nulls], key=repr)


def test_a_swap_that_stopped_between_files_is_finished(spark, folder, monkeypatch):
    sinks.upsert(spark.createDataFrame([(f"{i}", 1, 2024, i) for i in range(1, 7)], ROWS), folder, ["k"])
    move, done = sinks._move_in, []
    monkeypatch.setattr(sinks, "_move_in", lambda *a: move(*a) if not done.append(1) and len(done) < 3 else 1 / 0)
    update = spark.createDataFrame([(f"{i}", 2, 2024, i) for i in range(1, 6)] + [("n", 2, 2024, 3)], ROWS)
    with pytest.raises(ZeroDivisionError):
        sinks.upsert(update, folder, ["k"])
    monkeypatch.undo()
    assert sinks.finish_upsert(spark, folder) and not sinks.finish_upsert(spark, folder)
    assert content(spark, folder) == [*[(f"{i}", 2, 2024, i) for i in range(1, 6)], ("6", 1, 2024, 6), ("n", 2, 2024, 3)]


def test_a_first_load_that_fails_leaves_no_table(spark, folder):
    twice = spark.createDataFrame([("b", 1, 2024, 1), ("b", 2, 2024, 2)], ROWS)
    with pytest.raises(ValueError, match="more than once"):
        sinks.upsert(twice, folder, ["k"])
    sinks.upsert(twice.filter("v > 5"), folder, ["k"])
    assert not os.path.exists(folder.removeprefix("file:"))
    sinks.upsert(twice.filter("v = 1"), folder, ["k"])
    assert content(spark, folder) == [("b", 1, 2024, 1)]


def test_many_small_files_of_plain_folders_are_put_together(spark, folder):
    for i in range(6):
        sinks.upsert(spark.createDataFrame([(f"{i}-{n}", 0, 2024, 1) for n in range(3)], ROWS), folder, ["k"])
    names = [f for f in os.listdir(f"{folder.removeprefix('file:')}/year=2024/month=1") if f.endswith(".parquet")]
    assert len(names) <= 5 and len(content(spark, folder)) == 18
