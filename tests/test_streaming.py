from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from conftest import plan_of, rows_of
from test_rides import _brute_flags, odd_rides

from ridelake.functions import ridejson
from ridelake.plans import stream_jobs
from ridelake.streaming import anomalies, rides, sinks

PARTITIONS = 4


def text_of(row) -> str:
    ride_id, vendor, start, end, people, miles, fare, location = row
    fields = dict(
        ride_id=ride_id, vendor_id=vendor or "", pickup_datetime=start.isoformat(), dropoff_datetime=end.isoformat(),
        passenger_count=people, trip_distance=miles, fare_amount=fare, pickup_location_id=location,
    )
    return json.dumps(fields)


def write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def ordered():
    return sorted(odd_rides(400), key=lambda r: (r[2], r[0]))


def test_state_per_vendor_survives_a_restart(spark, folder):
    own, rows = rides.stream_session(spark, PARTITIONS), ordered()
    for i, part in enumerate((rows[:150], rows[150:])):
        write_lines(f"{folder}/in", f"part{i}.txt", map(text_of, part))
        payloads = anomalies.anomaly_payloads(anomalies.ride_anomalies_stream(rides.raw_stream(own, f"{folder}/in")))
        finish(sinks.sink_stream_parquet(payloads, f"{folder}/out", f"{folder}/check", None))
    got = [json.loads(r.payload) for r in spark.read.parquet(f"{folder}/out").collect()]
    assert {r["ride_id"]: r["reasons"] for r in got} == _brute_flags(rows)
    assert list(got[0]) == list(anomalies.ANOMALY_FIELDS)


def test_rides_of_a_microbatch_are_scored_in_their_order(spark, folder):
    """However they lie in its files, and whichever task reads them."""
    own, rows = rides.stream_session(spark, PARTITIONS), ordered()
    for i, part in enumerate((rows[:150], rows[150:])):
        for k in range(3):
            write_lines(f"{folder}/in", f"part{i}-{k}.txt", map(text_of, part[k::3][::-1]))
        payloads = anomalies.anomaly_payloads(anomalies.ride_anomalies_stream(rides.raw_stream(own, f"{folder}/in")))
        finish(sinks.sink_stream_parquet(payloads, f"{folder}/out", f"{folder}/check", None))
    got = [json.loads(r.payload) for r in spark.read.parquet(f"{folder}/out").collect()]
    assert {r["ride_id"]: r["reasons"] for r in got} == _brute_flags(rows) and len(got) == len(_brute_flags(rows))


def test_microbatches_give_the_same_and_replace_a_repeated_batch(spark, folder):
    own, rows = rides.stream_session(spark, PARTITIONS), ordered()
    for i, part in enumerate((rows[:150], rows[150:])):
        write_lines(f"{folder}/in", f"part{i}.txt", map(text_of, part))
        if i == 1:
            # What a run that failed in the middle of this batch would leave behind.
            spark.range(3).write.parquet(f"{folder}/out/batch=1")
            spark.range(3).write.parquet(f"{folder}/state/batch=1")
        raw = rides.raw_stream(own, f"{folder}/in")
        finish(anomalies.anomaly_batches(raw, f"{folder}/out", f"{folder}/state", f"{folder}/check", None))
    got = spark.read.parquet(f"{folder}/out/batch=0", f"{folder}/out/batch=1").collect()
    assert {r.ride_id: r.reasons for r in got} == _brute_flags(rows)


def test_fanout_replaces_a_repeated_batch(spark, folder):
    writers = [sinks.batch_folder(f"{folder}/a"), sinks.batch_folder(f"{folder}/b", "json")]
    for _ in range(2):
        for write in writers:
            write(spark.range(5), 0)
    assert spark.read.parquet(f"{folder}/a").count() == spark.read.json(f"{folder}/b").count() == 5


def test_broken_events_are_skipped_and_missing_fields_null(spark, folder):
    own = rides.stream_session(spark, PARTITIONS)
    good = '{"ride_id":"a","pickup_datetime":"2024-01-15T08:30:00+00:00","fare_amount":"x","vendor_id":3}'
    write_lines(f"{folder}/in", "x.txt", [good, "{nope", "[]", '{"ride_id":"b","pickup_datetime":"later"}'])
    finish(sinks.sink_stream_parquet(rides.ride_stream(own, f"{folder}/in"), f"{folder}/out", f"{folder}/check", None))
    assert rows_of(spark.read.parquet(f"{folder}/out"), "ride_id", "vendor_id", "fare_amount") == [("a", "3", None)]


def test_a_text_is_parsed_once(spark):
    """Filters on what was read from it do not read it again."""
    texts = spark.createDataFrame([(x,) for x in ('{"ride_id":"a"}', ' \t{"ride_id":null}', "[]", "7", "{nope", "", None)], "value string")
    strict, loose = ridejson.parse_ride_json(texts), rides.event_time(ridejson.read_ride_fields(texts))
    assert rows_of(strict, "ride_id", "fare_amount") == [("a", 0.0)] and loose.count() == 0
    assert rows_of(ridejson.read_ride_fields(texts), "ride_id") == [("a",), (None,)]
    assert plan_of(strict).count("parseJson") == plan_of(loose).count("parseJson") == 1
    assert plan_of(strict).count("$.fare_amount") == 2


def test_late_rides_are_dropped_and_counted(spark, folder):
    own = rides.stream_session(spark, PARTITIONS)
    ride = '{{"ride_id":"{}","pickup_datetime":"2024-01-15T{}","fare_amount":1}}'
    batches = (["10:00:00", "10:30:00"], ["10:01:00", "10:29:55"], ["11:00:00"])
    dropped = 0
    for i, times in enumerate(batches):
        write_lines(f"{folder}/in", f"{i}.txt", [ride.format(f"{i}{t}", t) for t in times])
        metrics = rides.tumbling_metrics(rides.ride_stream(own, f"{folder}/in"))
        query = sinks.sink_stream_parquet(metrics, f"{folder}/out", f"{folder}/check", None)
        finish(query)
        dropped += sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 1
    got = [(r.window_start.strftime("%H:%M"), r.ride_count) for r in spark.read.parquet(f"{folder}/out").collect()]
    assert sorted(got) == [("10:00", 1), ("10:25", 1), ("10:30", 1)]


def test_topic_source_without_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        rides.raw_stream(spark, "kafka", {"kafka.bootstrap.servers": "none:9", "subscribe": "rides"})


def test_caller_settings_stay(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rides.stream_session(spark, 3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


METRICS = "metric_type string, window_start timestamp, window_end timestamp, ride_count bigint, avg_fare double, total_revenue double, avg_distance double, pickup_location_id string"


def test_metrics_job_fills_both_sinks_once(spark, folder):
    """A batch that is repeated replaces its output in either sink; a restart repeats no window."""
    own = rides.stream_session(spark, PARTITIONS)
    times = (["10:00:00", "10:01:00", "10:07:00"], ["11:30:00"], ["13:30:00"])
    for i, moments in enumerate(times):
        lines = [json.dumps(dict(ride_id=m, pickup_datetime=f"2024-01-15T{m}.000250+00:00", fare_amount=2.0, pickup_location_id="7")) for m in moments]
        write_lines(f"{folder}/in", f"{i}.txt", lines)
        if i == 1:
            spark.range(3).write.parquet(f"{folder}/files/batch=2")
        finish(stream_jobs.run_metrics(own, f"{folder}/in", f"{folder}/texts", f"{folder}/files", f"{folder}/check", None))
    texts = rows_of(stream_jobs.committed(spark, f"{folder}/texts", METRICS, "json"))
    files = rows_of(stream_jobs.committed(spark, f"{folder}/files", METRICS))
    assert texts == files and len(set(texts)) == len(texts)
    of_kind = lambda kind: [(r[1].strftime("%H:%M:%S.%f"), r[3]) for r in files if r[0] == kind]
    assert sorted(of_kind("tumbling_5m")) == [("10:00:00.000000", 2), ("10:05:00.000000", 1), ("11:30:00.000000", 1)]
    assert sorted(of_kind("session_30m_gap")) == [("10:00:00.000250", 3), ("11:30:00.000250", 1)]
    assert sum(n for _, n in of_kind("sliding_15m_5m")) == 12


def test_rides_wait_for_those_before_them(spark, folder):
    """Rides that arrive out of order are scored in order, those at the end when their time has come."""
    own, rows = rides.stream_session(spark, PARTITIONS), ordered()
    shuffled = [rows[i] for i in sorted(range(len(rows)), key=lambda i: i + (i * 37) % 20)]
    latest = max(r[2] for r in rows)
    closing = ("closing", "9", latest + dt.timedelta(days=9), latest + dt.timedelta(days=9, minutes=5), 1, 1.0, 1.0, "1")
    for i, part in enumerate((shuffled[:100], shuffled[100:250], [], shuffled[250:], [closing])):
        write_lines(f"{folder}/in", f"part{i}.txt", [*map(text_of, part), "{broken"])
        raw = rides.raw_stream(own, f"{folder}/in")
        finish(anomalies.anomaly_batches(raw, f"{folder}/out", f"{folder}/state", f"{folder}/check", None, 86_400))
    got = [r for r in stream_jobs.committed(spark, f"{folder}/out", "ride_id string, reasons array<string>").collect()]
    assert {r.ride_id: r.reasons for r in got} == _brute_flags(rows) and len(got) == len(_brute_flags(rows))
    waiting = spark.read.parquet(f"{folder}/state/waiting/batch=4")
    assert rows_of(waiting.filter("NOT _newest"), "ride_id") == [("closing",)]
