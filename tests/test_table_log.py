from __future__ import annotations

import os
import random
from datetime import datetime

import numpy as np
import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from ridelake.plans import medallion
from ridelake.sources import sinks, table_log, tables

ROWS = "k string, v int, year int, month int"


def content(spark, path, *columns):
    return rows_of(tables.scan_table(spark, path), *(columns or ("k", "v", "year", "month")))


def merged(spark, path, rows, schema=ROWS, **options):
    return table_log.merge(spark.createDataFrame(rows, schema), path, ["k"], **options)


def files(spark, path, version=None):
    return {r.file: r.rows for r in table_log.listed_files(spark, path, table_log.snapshot(spark, path, version)).collect()}


def test_updates_moves_and_inserts(spark, folder):
    merged(spark, folder, [("a", 1, 2024, 1), ("b", 1, 2024, 1), ("c", 1, 2024, 2), ("d", 1, 2024, 3)])
    expected = [("a", 2, 2024, 1), ("b", 1, 2024, 1), ("c", 2, 2024, 4), ("d", 1, 2024, 3), ("e", 2, 2024, 3)]
    for version in (1, 2):
        assert merged(spark, folder, [("a", 2, 2024, 1), ("c", 2, 2024, 4), ("e", 2, 2024, 3)]) == version
        assert content(spark, folder) == expected
    old = table_log.read(spark, folder, version=0)
    assert rows_of(old, "k", "v") == [("a", 1), ("b", 1), ("c", 1), ("d", 1)]


@pytest.mark.parametrize("upsert", [sinks.upsert, table_log.merge])
def test_partitions_by_text(spark, folder, upsert):
    """Names that a folder name escapes or takes for numbers: no stale row stays, none comes twice."""
    schema = "k string, v string, p string"
    steps = [
        [("1", "old", "a:b"), ("2", "x", "02"), ("3", "x", "02"), ("4", "x", "01"), ("5", "x", "a%b c")],
        [("1", "new", "c"), ("2", "new", "02"), ("5", "new", "01")],
    ]
    for rows in steps:
        upsert(spark.createDataFrame(rows, schema), folder, ["k"], partitions=["p"])
    read = tables.scan_table(spark, folder) if upsert is table_log.merge else spark.read.schema(schema).parquet(folder)
    assert rows_of(read, "k", "v", "p") == [("1", "new", "c"), ("2", "new", "02"), ("3", "x", "02"), ("4", "x", "01"), ("5", "new", "01")]


def test_any_partition_value_comes_back(spark, folder):
    values = ["", None, "01", "1", "a=b/c", "__HIVE_DEFAULT_PARTITION__", "ü é", "x" * 400, "."]
    rows = [(str(i), p) for i, p in enumerate(values)]
    for n in (len(rows), 4):
        table_log.merge(spark.createDataFrame(rows[:n], "k string, p string"), folder, ["k"], partitions=["p"])
        assert rows_of(tables.scan_table(spark, folder), "k", "p") == sorted(rows, key=repr)
    listed = table_log.listed_files(spark, folder, table_log.snapshot(spark, folder))
    assert {r.part.p for r in listed.collect()} == set(values)


def test_only_files_with_a_received_key_are_written_anew(spark, folder):
    rows = [(f"{i:04d}", 0, 2024, i % 6) for i in range(600)]
    merged(spark, folder, rows)
    before = files(spark, folder)
    merged(spark, folder, [("0007", 1, 2024, 1), ("absent", 1, 2024, 5)])
    after = files(spark, folder)
    gone = before.keys() - after.keys()
    assert len(gone) == 1 and sum(after.values()) == 601
    parts = {r.file: r.part.month for r in table_log.listed_files(spark, folder, table_log.snapshot(spark, folder, 0)).collect()}
    assert [parts[f] for f in gone] == [1]
    # The content received lies in one place, as does what was kept beside it.
    new = [f for f in after if f not in before]
    assert sorted((f.split("/")[1], after[f]) for f in new) == [("kept", 99), ("received", 1), ("received", 1)]


def test_more_keys_than_are_sent_to_filters(spark, folder, monkeypatch):
    rows = [(f"{i}", 0, 2024, i % 3) for i in range(300)]
    merged(spark, folder, rows)
    monkeypatch.setattr(table_log, "MAX_PROBES", 10)
    merged(spark, folder, [(f"{i}", 1, 2024, i % 3) for i in range(0, 300, 6)])
    assert content(spark, folder) == sorted(((k, int(int(k) % 6 == 0), y, m) for k, _, y, m in rows), key=repr)
    month_1 = [f for f in files(spark, folder, 0) if f in files(spark, folder)]
    assert len(month_1) == 2  # no key of months 1 and 2 came


def test_equals_a_dictionary(spark, folder):
    random_ = random.Random(4)
    held = {}
    for _ in range(6):
        batch = {f"{random_.randrange(60)}": (random_.randrange(1000), 2024, random_.randrange(4)) for _ in range(random_.randrange(1, 25))}
        merged(spark, folder, [(k, *v) for k, v in batch.items()])
        held |= batch
        assert content(spark, folder) == sorted([(k, *v) for k, v in held.items()], key=repr)


def test_null_keys_copies_and_no_rows(spark, folder):
    rows = [("a", 1, 2024, 1), ("a", 3, 2024, 1), ("a", 2, 2024, 1), (None, 7, 2024, 1), (None, 8, 2024, 1)]
    merged(spark, folder, rows, newest=["v"])
    assert merged(spark, folder, [(None, 9, None, None)], newest=["v"]) == 1
    assert merged(spark, folder, []) == 1
    assert content(spark, folder) == sorted([("a", 3, 2024, 1), (None, 7, 2024, 1), (None, 8, 2024, 1), (None, 9, None, None)], key=repr)
    with pytest.raises(ValueError, match="more than once"):
        merged(spark, folder, rows)
    assert table_log.versions(spark, folder) == [0, 1]
    assert len(os.listdir(f"{folder}/data")) == 3  # two updates, and the one without rows


def test_empty_table(spark, folder):
    assert merged(spark, folder, []) == 0
    assert content(spark, folder) == []
    merged(spark, folder, [("a", 1, 2024, 1)])
    assert content(spark, folder) == [("a", 1, 2024, 1)]


def test_columns_are_added_and_keep_their_type(spark, folder):
    merged(spark, folder, [("a", 1, 2024, 1), ("b", 1, 2024, 1)])
    merged(spark, folder, [("a", 2, 2024, 1, 5)], ROWS + ", w int")
    merged(spark, folder, [("c", 3, 2024, 1)])
    assert content(spark, folder, "k", "v", "w") == [("a", 2, 5), ("b", 1, None), ("c", 3, None)]
    with pytest.raises(ValueError, match="column v"):
        merged(spark, folder, [("c", "x", 2024, 1)], ROWS.replace("v int", "v string"))
    with pytest.raises(ValueError, match="partitions"):
        merged(spark, folder, [("c", 1, 2024, 1)], partitions=["year"])


def test_without_partitions_and_with_keys_of_several_types(spark, folder):
    schema = "i long, t timestamp_ntz, d double, v int"
    rows = [(i, datetime(2024, 1, 1, i % 24, 0, 0, 250), float("nan") if i == 3 else i / 4, 0) for i in range(40)]
    for n in (40, 5):
        changed = spark.createDataFrame([(*r[:3], n) for r in rows[:n]], schema)
        table_log.merge(changed, folder, ["i", "t", "d"], partitions=[])
    assert rows_of(tables.scan_table(spark, folder).groupBy("v").count()) == [(40, 35), (5, 5)]


def test_a_number_that_is_taken_is_not_published_again(spark, folder, monkeypatch):
    """Another update comes between: both are in the result."""
    merged(spark, folder, [("a", 1, 2024, 1), ("b", 1, 2024, 1)])
    describe, done = table_log._describe, []

    def late(*args):
        if not done:
            done.append(1)
            merged(spark, folder, [("b", 2, 2024, 1), ("c", 2, 2024, 1)])
        return describe(*args)

    monkeypatch.setattr(table_log, "_describe", late)
    assert merged(spark, folder, [("a", 3, 2024, 1), ("c", 3, 2024, 1)]) == 2
    assert content(spark, folder, "k", "v") == [("a", 3), ("b", 2), ("c", 3)]
    assert not [f for f in os.listdir(f"{folder}/log") if f.endswith("draft")]


def test_an_update_that_fails_is_not_seen(spark, folder, monkeypatch):
    merged(spark, folder, [("a", 1, 2024, 1)])
    monkeypatch.setattr(table_log, "_publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        merged(spark, folder, [("a", 2, 2024, 1)])
    assert content(spark, folder, "k", "v") == [("a", 1)]
    assert len(os.listdir(f"{folder}/data")) == 1


def test_a_reader_keeps_its_snapshot_until_it_expires(spark, folder):
    for v in range(4):
        merged(spark, folder, [("a", v, 2024, 1), (f"x{v}", v, 2024, 2)])
    reader = table_log.read(spark, folder, version=2)
    assert table_log.expire(spark, folder, keep=2) == 2  # the first two files that held the first key
    assert rows_of(reader, "k", "v") == [("a", 2), ("x0", 0), ("x1", 1), ("x2", 2)]
    assert table_log.versions(spark, folder) == [2, 3] and len(content(spark, folder)) == 5
    with pytest.raises(ValueError, match="no snapshot 0"):
        table_log.read(spark, folder, version=0)
    assert table_log.expire(spark, folder, keep=2) == 0


def test_files_of_other_partitions_are_not_scanned(spark, folder):
    merged(spark, folder, [(str(i), i, 2024, i) for i in range(1, 13)])
    some = tables.scan_table(spark, folder, within=(F.col("month") >= 3) & (F.col("month") < 5))
    assert len(some.inputFiles()) == 2 and rows_of(some, "k") == [("3",), ("4",)]
    plain = f"{folder}-plain"
    tables.scan_table(spark, folder).write.partitionBy("year", "month").parquet(plain)
    assert rows_of(tables.scan_table(spark, plain, within=F.col("month") == 3), "k") == [("3",)]


def test_filters_know_their_keys():
    random_ = np.random.default_rng(1)
    keys, others = random_.integers(-(2**63), 2**63, (2, 5000))
    bits = 1 << 17
    flags = np.zeros(bits, bool)
    for at in table_log.bloom_places(keys, bits):
        flags[at] = True
    known = [np.all([flags[at] for at in table_log.bloom_places(h, bits)], axis=0) for h in (keys, others)]
    assert known[0].all() and known[1].mean() < 0.001


def test_silver_job_uses_snapshots(spark, folder):
    trips = spark.createDataFrame(
        [(1, datetime(2024, m, 5, 8), datetime(2024, m, 5, 8, 20), 2, 3.5, 15.5, 18.0, 161, 237) for m in (1, 2, 3)],
        "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count long, "
        "trip_distance double, fare_amount double, total_amount double, PULocationID long, DOLocationID long",
    )
    trips.write.parquet(f"{folder}/raw")
    medallion.run_bronze(spark, f"{folder}/raw", f"{folder}/bronze")
    for _ in range(2):
        medallion.run_silver(spark, f"{folder}/bronze", f"{folder}/silver")
    assert table_log.versions(spark, f"{folder}/silver") == [0, 1]
    assert tables.scan_table(spark, f"{folder}/silver").count() == 3
    assert all(medallion.run_gold(spark, f"{folder}/silver", f"{folder}/gold", "2024-02-01", "2024-03-01").values())
    assert rows_of(spark.read.parquet(f"{folder}/gold/nyc_taxi/hourly_stats"), "trip_count") == [(1,)]


def test_rows_that_stay_are_not_shuffled(spark, folder, monkeypatch):
    spread, given = table_log.spread_for_write, []
    monkeypatch.setattr(table_log, "spread_for_write", lambda df, by: given.append(by) or spread(df, by))
    monkeypatch.setattr(table_log, "ROWS_AT_ONCE", 120, raising=False)
    schema = ROWS + ", _metadata string, file string"
    held = {f"{i:04d}": (0, 2024, i % 6, f"m{i}", "f") for i in range(600)}
    update = {f"{i:04d}": (1, 2025, i % 5, "new", None) for i in range(0, 660, 11)}
    nulls = [(None, i, 2024, 1, "null", "f") for i in range(3)]
    merged(spark, folder, [*[(k, *v) for k, v in held.items()], *nulls], schema)
    merged(spark, folder, [*[(k, *v) for k, v in update.items()], *nulls], schema)
    assert len(given) == 2  # what was received, twice
    want = sorted([*[(k, *v) for k, v in (held | update).items()], *nulls, *nulls], key=repr)
    assert content(spark, folder, "k", "v", "year", "month", "_metadata", "file") == want
    assert not os.path.exists(f"{folder}/replaced") or not os.listdir(f"{folder}/replaced")


def test_many_small_files_are_put_together(spark, folder):
    for i in range(6):
        merged(spark, folder, [(f"{i}-{n}", 0, 2024, 1) for n in range(3)])
    merged(spark, folder, [(f"{i}-0", 1, 2024, 2) for i in range(6)])
    assert sorted(files(spark, folder).values()) == [6, 12]
    assert content(spark, folder) == sorted([(f"{i}-{n}", int(n == 0), 2024, 2 if n == 0 else 1) for i in range(6) for n in range(3)], key=repr)


def test_rows_that_lie_by_partition_are_not_shuffled(spark, folder, monkeypatch):
    spread, given = table_log.spread_for_write, []
    monkeypatch.setattr(table_log, "spread_for_write", lambda df, by: given.append(by) or spread(df, by))
    merged(spark, folder, [(f"{i:04d}", 0, 2024, i % 6) for i in range(600)])
    held = table_log.read(spark, folder, version=0)
    table_log.merge(held.filter("k < '0100'").withColumn("v", F.lit(1)), folder, ["k"], keys_fix_partition=True, lies_apart=True)
    assert len(given) == 1 and content(spark, folder) == [(f"{i:04d}", int(i < 100), 2024, i % 6) for i in range(600)]
    assert all(r.part is not None for r in table_log.listed_files(spark, folder, table_log.snapshot(spark, folder)).collect())


def test_keys_are_compared_by_digest(spark, folder, monkeypatch):
    """However long a key is, 96 bits of it are shuffled; keys that differ in one sign are told apart."""
    digest, given = table_log.key_digest, []
    monkeypatch.setattr(table_log, "key_digest", lambda keys: given.append(keys) or digest(keys), raising=False)
    keys = ["x" * 1000 + str(i) for i in range(200)]
    merged(spark, folder, [(k, 0, 2024, 1) for k in keys])
    merged(spark, folder, [(k, 1, 2024, 2) for k in [*keys[::3], "x" * 1000 + "y"]])
    assert given and content(spark, folder, "k", "v") == sorted([*[(k, int(i % 3 == 0)) for i, k in enumerate(keys)], ("x" * 1000 + "y", 1)], key=repr)


def test_evolving_loads_are_shuffled_once(spark, monkeypatch):
    """The later loads are read from the table, where they lie by partition."""
    from ridelake.queries import storage

    spread, given = table_log.spread_for_write, []
    for module in (table_log, storage):
        monkeypatch.setattr(module, "spread_for_write", lambda df, by: given.append(by) or spread(df, by), raising=False)
    assert storage.upsert_evolving(spark, SMALL).count() == 6000
    assert len(given) == 1
