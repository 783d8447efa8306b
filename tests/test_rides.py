from __future__ import annotations

import datetime as dt
import math
import random
import re

import numpy as np
import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from ridelake.functions.clock import epoch_seconds
from ridelake.functions.ridejson import parse_ride_json, read_ride_fields
from ridelake.operators import anomalies, windows
from ridelake.operators.ordered import data_cut

SCHEMA = (
    "ride_id string, vendor_id string, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, passenger_count int, "
    "trip_distance double, fare_amount double, pickup_location_id string"
)
START = dt.datetime(2024, 1, 1)


def ride(number, minutes, vendor="1", fare=10.0, location="7", miles=1.0, people=1, ride_minutes=10.0):
    at = START + dt.timedelta(minutes=minutes)
    return (f"r{number:05d}", vendor, at, at + dt.timedelta(minutes=ride_minutes), people, miles, fare, location)


def rides(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_a_gap_of_exactly_thirty_minutes_keeps_the_session(spark):
    tick = 1 / 60e6
    df = rides(spark, [ride(0, 0), ride(1, 30), ride(2, 60 + tick), ride(3, 200, location=None), ride(4, 0, location="")])
    got = rows_of(windows.session_30m(df), "pickup_location_id", "ride_count")
    assert got == sorted([("", 1), ("7", 1), ("7", 2), (None, 1)], key=repr)
    assert windows.session_global(df).select("window_start").distinct().count() == 3


def _brute_sessions(rows):
    found, open_ = [], {}
    for row in sorted(rows, key=lambda r: r[2]):
        key, at = row[7], row[2]
        if key in open_ and at - open_[key][1] <= dt.timedelta(minutes=30):
            open_[key][1:] = [at, open_[key][2] + 1]
        else:
            open_[key] = [at, at, 1]
            found.append((key, open_[key]))
    return sorted((k, s[0], s[1] + dt.timedelta(minutes=30), s[2]) for k, s in found)


def test_sessions_match_brute_force_with_a_hot_location(spark):
    rng = random.Random(7)
    rows = [ride(i, rng.uniform(0, 60 * 24 * 40), location="hot" if i % 3 else str(i % 5)) for i in range(3000)]
    got = rows_of(windows.session_30m(rides(spark, rows)), "pickup_location_id", "window_start", "window_end", "ride_count")
    assert sorted(got) == _brute_sessions(rows)


def test_session_plan_has_no_nested_loop_join(spark):
    plan = plan_of(windows.session_global(rides(spark, [ride(0, 0)])))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_gap_fill(spark):
    df = rides(spark, [ride(0, 0, fare=4.0), ride(1, 1, fare=6.0), ride(2, 11, fare=1.0)])
    got = [tuple(r)[1:] for r in windows.tumbling_gap_fill(df).orderBy("window_start").collect()]
    assert got == [(2, 5.0, 10.0), (0, None, 0.0), (1, 1.0, 1.0)]


def test_rolling_mean_excludes_exactly_fifteen_minutes_ago(spark):
    df = rides(spark, [ride(0, 0, fare=1.0), ride(1, 15, fare=3.0), ride(2, 29.9, fare=5.0)])
    got = [r[0] for r in windows.rolling_mean(df, "fare_amount").orderBy("ride_id").select("rolling_mean").collect()]
    assert got == [1.0, 3.0, 4.0]


@pytest.mark.parametrize("chunk", [900, 3600, 86_400])
def test_rolling_mean_matches_brute_force(spark, chunk):
    rng = random.Random(3)
    rows = [ride(i, rng.uniform(0, 600), vendor=str(i % 2), fare=rng.uniform(0, 9)) for i in range(400)]
    got = windows.rolling_mean(rides(spark, rows), "fare_amount", keys=("vendor_id",), chunk_seconds=chunk)
    for row in got.collect():
        near = [
            r[6] for r in rows
            if r[1] == row.vendor_id and row.pickup_ts - dt.timedelta(minutes=15) < r[2] <= row.pickup_ts
        ]
        assert math.isclose(row.rolling_mean, sum(near) / len(near), rel_tol=1e-9)
    assert got.count() == len(rows)


def test_rolling_mean_does_not_walk_through_frames(spark):
    """Every frame begins where its partition does; nulls do not count, an infinite value stays within its frames."""
    rows = [ride(0, 0, fare=1.0), ride(1, 1, fare=None), ride(2, 10, fare=float("inf")), ride(3, 20, fare=2.0), ride(4, 20, fare=4.0), ride(5, 25, fare=6.0)]
    made = windows.rolling_mean(rides(spark, rows), "fare_amount")
    begins = re.findall(r"specifiedwindowframe\(\w+, ([^,]*),", plan_of(made))
    assert begins and all(b.startswith("unboundedpreceding") for b in begins)
    assert [r[0] for r in made.orderBy("ride_id").select("rolling_mean").collect()] == [1.0, 1.0, math.inf, math.inf, math.inf, 4.0]
    empty = windows.rolling_mean(rides(spark, [ride(0, 0, fare=None)]), "fare_amount")
    assert empty.first()["rolling_mean"] is None


# What makes a ride odd, given it and the fares that its vendor had before.
ODD = {
    "invalid_fare_or_passengers": lambda r, past: r[6] < 0 or r[4] <= 0,
    "distance_over_100_miles": lambda r, past: r[5] > 100,
    "fare_gt_3x_rolling_mean": lambda r, past: bool(past) and r[6] * len(past) > 3 * sum(past),
    "fare_gt_mean_plus_3std": lambda r, past: len(past) > 1 and r[6] > _limit(past) and np.std(past) > 1e-9,
    "speed_over_100_mph": lambda r, past: r[3] > r[2] and r[5] / ((r[3] - r[2]) / dt.timedelta(hours=1)) > 100,
}


def _limit(past):
    return np.mean(past) + 3 * np.std(past)


def _brute_flags(rows):
    fares, flagged = {}, {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        past = fares.setdefault(row[1] or "unknown", [])
        why = [name for name, odd in ODD.items() if odd(row, past)]
        past.append(row[6])
        flagged |= {row[0]: why} if why else {}
    return flagged


def odd_rides(count=600):
    rng = random.Random(11)
    rows = []
    for i in range(count):
        rows.append(
            ride(
                i, rng.uniform(0, 60 * 72), vendor=rng.choice(["1", "1", "1", "2", "", None]),
                fare=rng.choice([rng.uniform(-1, 20), rng.uniform(0, 200)]), miles=rng.choice([1.0, 5.0, 101.0]),
                people=rng.randint(0, 6), ride_minutes=rng.choice([-1, 0, 2, 30]),
            )
        )
    return rows


@pytest.mark.parametrize("chunk", [8, 100, 10**8])
def test_anomalies_match_brute_force_whatever_the_chunk(spark, chunk):
    rows = odd_rides()
    got = {r.ride_id: r.reasons for r in anomalies.ride_anomalies(rides(spark, rows), chunk).collect()}
    assert got == _brute_flags(rows)


def test_one_minute_of_a_vendor_is_several_chunks(spark):
    """10^5 rides, a third of them without a time, and an id that comes twice: sums before each as along the whole order."""
    n = 100_000
    at = F.when(F.col("id") % 3 > 0, F.lit(START) + F.make_dt_interval(secs=F.col("id") * 7919 % 60)).cast("timestamp_ntz")
    name = F.lpad((F.col("id") * 104_729 % n).cast("string"), 6, "0")
    minute = spark.range(n).select(name.alias("ride_id"), F.lit("1").alias("vendor_id"), at.alias("pickup_ts"), (F.col("id") % 100).cast("double").alias("fare_amount"))
    keyed = minute.withColumn("_tie", F.lit(0))
    sizes = keyed.groupBy(data_cut(keyed, ["vendor_id"], ["pickup_ts", "ride_id"], 5_000).alias("chunk")).count().toPandas()
    assert len(sizes) > 10 and sizes["count"].max() < 20_000
    got = anomalies.running_vendor_stats(minute, 5_000).toPandas().sort_values(["pickup_ts", "ride_id"], na_position="first")
    assert got["prior_count"].tolist() == list(range(n))
    sums = np.concatenate([[0], got["fare_amount"].cumsum()[:-1]])
    assert np.allclose(got["prior_sum"], sums)


def test_chunks_follow_the_order_of_any_type(spark):
    texts = ["", "a", "a\0", "a\0\1", "a\1", "ab", "é", "日", None]
    times = [None, dt.datetime(1900, 1, 1, 0, 0, 0, 1), dt.datetime(1969, 12, 31), dt.datetime(2024, 3, 10, 2, 30, 0, 999_999)]
    rows = [(t, x, n) for t in times for x in texts for n in (None, -(2**63), -1, 0, 2**63 - 1)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, x string, n long").withColumn("u", F.col("t").cast("timestamp")).withColumn("k", F.lit(1))
    order = ["t", "x", "n", "u"]
    cut = data_cut(df, ["k"], order, 8)
    chunks = [r.c for r in df.select(*order, cut.alias("c")).orderBy(*[F.col(c).asc_nulls_first() for c in order]).collect()]
    assert chunks == sorted(chunks) and len(set(chunks)) > 5
    with pytest.raises(TypeError, match="double"):
        data_cut(df.withColumn("d", F.lit(0.5)), ["k"], ["d"])


def test_rides_without_time_come_first_and_count(spark):
    timeless = ("r9", "1", None, None, 1, 1.0, 50.0, "7")
    got = anomalies.running_vendor_stats(rides(spark, [timeless, ride(1, 0), ride(2, 60 * 48)]))
    assert rows_of(got, "ride_id", "prior_count", "prior_mean") == [("r00001", 1, 50.0), ("r00002", 2, 30.0), ("r9", 0, 0.0)]


def test_zscore_of_constant_and_missing_values(spark):
    flagged = anomalies.zscore_flag(spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double"), "v")
    assert rows_of(flagged, "z", "is_anomaly") == sorted([(0.0, False), (0.0, False), (None, False)], key=repr)


def test_event_times(spark):
    texts = ["1705307400", "1705307400000", "2024-01-15T08:30:00Z", "2024-01-15T08:30:00+00:00", " ", "", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(epoch_seconds("t")).collect()]
    assert got == [1705307400.0] * 4 + [None] * 4


def test_ride_json_edges(spark):
    full = '{"ride_id":"a","vendor_id":1,"passenger_count":2.7,"trip_distance":"3.5","fare_amount":9}'
    texts = [full, "{}", "{bad", "[]", "7", '{"fare_amount":null}', '{"passenger_count":"2.7"}', '{"fare_amount":"x"}', None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    strict = rows_of(parse_ride_json(df), "ride_id", "vendor_id", "passenger_count", "trip_distance", "fare_amount")
    assert strict == [("", "", 0, 0.0, 0.0), ("a", "1", 2, 3.5, 9.0)]
    loose = rows_of(read_ride_fields(df), "ride_id", "fare_amount")
    assert loose == sorted([("a", 9.0)] + [(None, None)] * 4, key=repr)


def test_anomalies_per_minute(spark):
    df = rides(spark, [ride(i, 10) for i in range(10)])
    got = rows_of(anomalies.anomalies_per_minute(df), "anomalies_per_minute")
    assert got == [(2.0,)] * 5


def test_tumbling_metric_layout(spark):
    got = windows.unified_window_metrics(rides(spark, [ride(0, 1, fare=None), ride(1, 2, fare=4.0)]))
    assert tuple(got.columns) == windows.METRIC_COLUMNS
    assert got.filter("metric_type = 'tumbling_5m'").select("ride_count", "avg_fare", "avg_distance").first() == (2, 4.0, None)
    assert got.groupBy("metric_type").count().count() == 3
    assert got.filter(F.col("metric_type") == "sliding_15m_5m").count() == 3


def test_gaps_are_filled_however_far_apart_rides_are(spark):
    """A stray ride of 1900 makes a long calendar, which comes from a range of numbers and not from one row's array."""
    stray = ("stray", "1", dt.datetime(1900, 1, 1), dt.datetime(1900, 1, 1, 1), 1, 1.0, 5.0, "7")
    filled = windows.tumbling_gap_fill(rides(spark, [stray, ride(1, 0), ride(2, 11)]))
    assert "Range (" in plan_of(filled) and "explode(sequence" not in plan_of(filled)
    days = (START - dt.datetime(1900, 1, 1)).days
    assert filled.count() == days * 288 + 3 and filled.filter("ride_count > 0").count() == 3
    assert windows.tumbling_gap_fill(rides(spark, [stray]).filter("ride_id = 'x'")).count() == 0
