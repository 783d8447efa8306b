from __future__ import annotations

import bisect
import datetime as dt
import random

import pandas as pd
import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from ridelake.operators import features, profiling
from ridelake.plans import feature_refresh
from ridelake.sources import table_log

DAY = dt.datetime(2024, 3, 10)
ZONE_ROWS = (
    "location_id bigint, event_timestamp timestamp_ntz, zone_avg_fare double, zone_trip_count bigint, zone_avg_distance double"
)
ASKED = "id int, location_id bigint, event_timestamp timestamp_ntz, fare_amount double"


def zone_rows(spark, *rows):
    return spark.createDataFrame([(z, t, f, 1, 1.0) for z, t, f in rows], ZONE_ROWS)


def zone_view(spark, *rows):
    df = zone_rows(spark, *rows)
    return features.ZONE_FEATURES.bind(lambda: df)


def ask(spark, *rows):
    return spark.createDataFrame([(i, z, t, 10.0) for i, (z, t) in enumerate(rows)], ASKED)


def historical(spark, asked, view, **kwargs):
    got = features.get_historical(asked, ["zone_features:zone_avg_fare"], [view], **kwargs)
    return {r.id: r.zone_features__zone_avg_fare for r in got.collect()}


def test_point_in_time_edges(spark):
    view = zone_view(spark, (1, DAY, 5.0), (1, DAY + dt.timedelta(days=3), 6.0), (2, DAY, 7.0), (None, DAY, 9.0))
    hour, week = dt.timedelta(hours=1), dt.timedelta(days=7)
    asked = ask(
        spark,
        (1, DAY),
        (1, DAY - hour),
        (1, DAY + dt.timedelta(days=3) - dt.timedelta(microseconds=1)),
        (2, DAY + week),
        (2, DAY + week + dt.timedelta(microseconds=1)),
        (3, DAY),
        (None, DAY),
        (1, None),
    )
    assert historical(spark, asked, view) == {0: 5.0, 1: None, 2: 5.0, 3: 7.0, 4: None, 5: None, 6: None, 7: None}


def test_equal_feature_times_take_the_greatest(spark):
    view = zone_view(spark, (1, DAY, 5.0), (1, DAY, 8.0), (1, DAY, 6.0))
    assert historical(spark, ask(spark, (1, DAY)), view) == {0: 8.0}
    got = features.lookup_latest(ask(spark, (1, DAY)), ["zone_features:zone_avg_fare"], [view])
    assert rows_of(got, "zone_features__zone_avg_fare") == [(8.0,)]


@pytest.mark.parametrize("chunk", [8, 100, 10**8])
def test_point_in_time_matches_brute_force_with_a_hot_zone(spark, chunk):
    rng = random.Random(5)
    moment = lambda: DAY + dt.timedelta(seconds=rng.randrange(0, 86_400 * 20, 900))
    known = {(rng.choice([1, 1, 1, 2, 3]), moment()): rng.uniform(1, 9) for _ in range(150)}
    asked = [(rng.choice([1, 1, 1, 1, 2, 4]), moment()) for _ in range(800)]
    by_zone = {}
    for (zone, at), fare in sorted(known.items()):
        by_zone.setdefault(zone, []).append((at, fare))
    expected = {}
    for i, (zone, at) in enumerate(asked):
        rows = by_zone.get(zone, [])
        place = bisect.bisect_right([t for t, _ in rows], at) - 1
        fresh = place >= 0 and at - rows[place][0] <= dt.timedelta(days=7)
        expected[i] = rows[place][1] if fresh else None
    view = zone_view(spark, *[(z, t, f) for (z, t), f in known.items()])
    assert historical(spark, ask(spark, *asked), view, chunk_rows=chunk) == expected


def test_history_of_a_key_is_split(spark):
    history = [(1, DAY + dt.timedelta(hours=i), float(i)) for i in range(400)]
    joined = features.asof_join(ask(spark, (1, DAY)), zone_rows(spark, *history), "location_id", ["zone_avg_fare"], chunk_rows=16)
    exchanges = [line for line in plan_of(joined).splitlines() if "Exchange hashpartitioning(_key" in line]
    assert exchanges and any("_chunk" in line for line in exchanges)


def test_one_instant_of_many_entity_rows_is_one_place_on_the_time_line(spark, monkeypatch):
    """All rows without a time of their own are asked as of one moment."""
    lines, once = [], features.computed_once
    monkeypatch.setattr(features, "computed_once", lambda df: lines.append(once(df)) or lines[-1])
    asked = spark.range(100_000).select(
        F.col("id").cast("int").alias("id"), (F.col("id") % 2 + 1).alias("location_id"), F.lit(DAY).cast("timestamp_ntz").alias("event_timestamp")
    )
    view = zone_view(spark, (1, DAY, 5.0), (1, DAY - dt.timedelta(days=1), 4.0))
    got = features.get_historical(asked, ["zone_features:zone_avg_fare"], [view])
    assert rows_of(got.groupBy("location_id", "zone_features__zone_avg_fare").count()) == [(1, 5.0, 50_000), (2, None, 50_000)]
    assert [df.count() for df in lines] == [4]


def test_views_of_one_entity_share_a_time_line(spark, monkeypatch):
    calls, once = [], features.computed_once
    monkeypatch.setattr(features, "computed_once", lambda df: calls.append(1) or once(df))
    slow = zone_view(spark, (1, DAY, 5.0), (2, DAY, 6.0))
    rows = zone_rows(spark, (1, DAY - dt.timedelta(days=2), 1.0), (1, DAY, 2.0))
    fast = features.FeatureView("fast", features.TAXI_ZONE, dt.timedelta(days=1), {"zone_avg_fare": "double"}, lambda: rows)
    asked = ask(spark, (1, DAY), (1, DAY - dt.timedelta(days=2)), (1, DAY - dt.timedelta(hours=5)), (2, DAY + dt.timedelta(days=3)), (None, DAY))
    got = features.get_historical(asked, ["zone_features:zone_avg_fare", "fast:zone_avg_fare"], [slow, fast])
    found = {r.id: (r.zone_features__zone_avg_fare, r.fast__zone_avg_fare) for r in got.collect()}
    assert found == {0: (5.0, 2.0), 1: (None, 1.0), 2: (None, None), 3: (6.0, None), 4: (None, None)} and len(calls) == 1


def test_missing_time_is_now_and_no_rows_is_an_error(spark):
    now = dt.datetime.now()
    view = zone_view(spark, (1, now - dt.timedelta(days=2), 5.0), (2, now - dt.timedelta(days=9), 6.0))
    untimed = ask(spark, (1, DAY), (2, DAY)).drop("event_timestamp")
    assert historical(spark, untimed, view) == {0: 5.0, 1: None}
    with pytest.raises(ValueError, match="empty"):
        historical(spark, untimed.filter("id > 9"), view)


def test_unknown_features_and_bad_sources_raise(spark):
    view = zone_view(spark, (1, DAY, 5.0))
    with pytest.raises(KeyError):
        features.lookup_latest(ask(spark, (1, DAY)), ["zone_features:nothing"], [view])
    with pytest.raises(ValueError, match="zone_trip_count"):
        bare = zone_rows(spark, (1, DAY, 5.0)).drop("zone_trip_count")
        features.ZONE_FEATURES.bind(lambda: bare).load()
    with pytest.raises(ValueError, match="no source"):
        features.ZONE_FEATURES.load()


def test_views_are_listed(spark):
    listed = {r.name: r for r in features.list_views(spark).collect()}
    assert {n: r.ttl_seconds for n, r in listed.items()} == {
        "hourly_trip_features": 86_400.0,
        "zone_features": 7 * 86_400.0,
        "daily_trip_features": 30 * 86_400.0,
        "fare_prediction_features": None,
    }
    assert listed["zone_features"].entities == ["taxi_zone"]
    assert ("zone_trip_count", "bigint") in [tuple(f) for f in listed["zone_features"].schema]
    assert listed["fare_prediction_features"].type == "on_demand_feature_view"


def test_fare_ratio_and_own_transformation(spark):
    view = zone_view(spark, (1, DAY, 4.0), (2, DAY, 0.0))
    asked = ask(spark, (1, DAY), (2, DAY), (3, DAY))
    made = features.on_demand(asked, features.FARE_PREDICTION_FEATURES, view)
    assert rows_of(made, "id", "expected_fare_ratio") == [(0, 2.5), (1, None), (2, None)]

    @F.pandas_udf("double")
    def excess(fare: pd.Series, usual: pd.Series) -> pd.Series:
        return fare - usual

    own = features.on_demand(
        asked, features.FARE_PREDICTION_FEATURES, view, lambda df: df.withColumn("excess", excess("fare_amount", "zone_avg_fare"))
    )
    assert rows_of(own.filter("id = 0"), "excess") == [(6.0,)]


def test_incremental_materialisation(spark, folder, monkeypatch):
    day = dt.timedelta(days=1)
    view = zone_view(spark, (1, DAY - 9 * day, 1.0), (1, DAY - day, 2.0), (2, DAY - 8 * day, 3.0), (1, DAY + day, 4.0))
    first = feature_refresh.materialize_incremental(spark, view, DAY, folder)
    assert rows_of(first, "location_id", "zone_avg_fare") == [(1, 2.0)]
    second = feature_refresh.materialize_incremental(spark, view, DAY + 2 * day, folder)
    assert rows_of(second, "location_id", "zone_avg_fare") == [(1, 4.0)]
    again = feature_refresh.materialize_incremental(spark, view, DAY + 2 * day, folder)
    assert rows_of(again, "location_id", "zone_avg_fare") == [(1, 4.0)]
    assert feature_refresh.materialized_to(spark, view, folder) == DAY + 2 * day
    # A run that dies while it writes leaves the table and its record as they were.
    monkeypatch.setattr(table_log, "_publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        feature_refresh.materialize_incremental(spark, view, DAY + 5 * day, folder)
    assert feature_refresh.materialized_to(spark, view, folder) == DAY + 2 * day
    assert rows_of(feature_refresh.latest_table(spark, view, folder)) == rows_of(again)


def test_an_incremental_run_leaves_other_buckets_alone(spark, folder):
    hour = dt.timedelta(hours=1)
    view = zone_view(spark, *[(z, DAY - hour, 1.0) for z in range(400)], *[(z, DAY + hour, 2.0) for z in (3, 7, 1000)])
    feature_refresh.materialize_incremental(spark, view, DAY, folder)
    path = f"{folder}/zone_features"
    listed = lambda n: {r.file: r.part["_bucket"] for r in table_log.listed_files(spark, path, table_log.snapshot(spark, path, n)).collect()}
    before = listed(0)
    latest = feature_refresh.materialize_incremental(spark, view, DAY + 2 * hour, folder)
    after = listed(1)
    touched = {before[f] for f in before.keys() - after.keys()}
    assert len(set(before.values())) > 30 and len(touched) == 2
    assert rows_of(latest.groupBy("zone_avg_fare").count()) == [(1.0, 398), (2.0, 3)]
    # A run without news moves the end on, and writes no row.
    feature_refresh.materialize_incremental(spark, view, DAY + 9 * hour, folder)
    assert listed(2) == after and feature_refresh.materialized_to(spark, view, folder) == DAY + 9 * hour
    assert feature_refresh.materialize_view(spark, view, DAY, DAY + 2 * hour, folder).count() == 3


def test_full_materialisation_is_inclusive(spark, folder):
    view = zone_view(spark, (1, DAY, 1.0), (2, DAY + dt.timedelta(days=1), 2.0), (3, DAY + dt.timedelta(days=2), 3.0))
    rows = feature_refresh.materialize_view(spark, view, DAY, DAY + dt.timedelta(days=1), folder)
    assert rows_of(rows, "location_id") == [(1,), (2,)]


def test_freshness_and_ranges(spark):
    rows = zone_rows(spark, (1, DAY, 5.0), (2, DAY, -1.0), (3, DAY, None))
    for hours, fresh in ((24, True), (25, False)):
        as_of = F.lit(DAY + dt.timedelta(hours=hours)).cast("timestamp_ntz")
        assert profiling.gold_freshness(rows, as_of, "event_timestamp").first()["fresh"] is fresh
    empty = profiling.gold_freshness(rows.filter("location_id > 9"), F.lit(DAY), "event_timestamp")
    assert empty.first()["fresh"] is False
    checked = profiling.feature_range_check(rows, {"zone_avg_fare": (0, 100), "zone_trip_count": (1, None)})
    assert rows_of(checked) == [("zone_avg_fare", 1, False), ("zone_trip_count", 0, True)]
