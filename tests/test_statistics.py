from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from ridelake.operators import drift, profiling, quantiles
from ridelake.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


def heavy_tailed(spark, n=20_000):
    """Ties, a far tail, missing values and not-a-number."""
    x = F.rand(3)
    value = (
        F.when(F.col("id") % 3 == 0, 7.0)
        .when(F.col("id") % 101 == 0, F.lit(None))
        .when(F.col("id") % 103 == 0, F.lit(float("nan")))
        .otherwise(F.pow(F.lit(10.0), x * 9))
    )
    return spark.range(n).select((F.col("id") % 4).alias("g"), value.alias("v"), (-value).alias("w")).checkpoint()


@pytest.mark.parametrize("accuracy", [50, 2000])
def test_quantiles_are_exact_whatever_the_sketch(spark, accuracy):
    df = heavy_tailed(spark)
    pdf = df.toPandas()
    got = {(r.column_name, r.prob): r.value for r in exact_quantiles(df, ["v", "w"], PROBS, accuracy=accuracy).collect()}
    for column in ("v", "w"):
        values = pdf[column].dropna().to_numpy()
        for prob in PROBS:
            assert math.isclose(got[column, prob], np.quantile(values, prob), rel_tol=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 2000, 2001, 19_999, 20_001, 50_000])
def test_quantiles_at_the_default_accuracy(spark, n):
    df = spark.range(n).select(F.col("id").cast("double").alias("v"))
    for row in exact_quantiles(df, ["v"], PROBS).collect():
        assert math.isclose(row.value, (n - 1) * row.prob, rel_tol=1e-12)


def test_quantiles_by_group(spark):
    df = heavy_tailed(spark, 4000)
    pdf = df.toPandas()
    got = exact_quantiles(df, ["v"], (0.25, 0.5), by=["g"], accuracy=100).collect()
    assert len(got) == 8
    for row in got:
        values = pdf[pdf.g == row.g].v.dropna()
        assert math.isclose(row.value, np.quantile(values, row.prob), rel_tol=1e-12)


def test_describe_equals_pandas(spark):
    df = heavy_tailed(spark, 3000)
    row = profiling.describe(df, ["v"]).first()
    expected = df.toPandas().v.describe()
    for ours, theirs in zip(row[1:], expected):
        assert math.isclose(ours, theirs, rel_tol=1e-9)


def test_statistics_of_no_rows(spark):
    df = spark.createDataFrame([], "v double, g string")
    assert profiling.describe(df, ["v"]).first()[:3] == ("v", 0, None)
    assert profiling.histogram(df, ["v"]).count() == 0
    assert profiling.missing_counts(df).count() == 2


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(16)] + [(None, 5.0)], "a double, b double")
    counts = {(r.column_name, r.bin): r["count"] for r in profiling.histogram(df, ["a", "b"]).collect()}
    assert [counts["a", b] for b in range(1, 16)] == list(np.histogram(np.arange(16.0), bins=15)[0])
    assert [counts["b", b] for b in range(1, 16)] == list(np.histogram(np.full(17, 5.0), bins=15)[0])


def test_box_summary(spark):
    rows = [("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 5.0), (None, 1.0), ("b", None)]
    got = rows_of(profiling.box_summary(spark.createDataFrame(rows, "g string, v double"), ["v"], "g"))
    assert got == [("a", "v", 2.0, 3.0, 4.0, 1.0, 4.0, 1), ("b", "v", 5.0, 5.0, 5.0, 5.0, 5.0, 0)]


def test_outliers(spark):
    df = spark.createDataFrame([(float(v), 1.0) for v in (1, 2, 3, 4, 100)] + [(None, 9.0)], "a double, b double")
    assert rows_of(profiling.iqr_outlier_counts(df, ["a", "b"])) == [("a", 1), ("any", 2), ("b", 1)]
    assert rows_of(profiling.remove_outliers(df, ["a", "b"]), "a") == [(1.0,), (2.0,), (3.0,), (4.0,)]


def test_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 3.0), (3.0, 6.0, 4.0)], "a double, b double, c double")
    got = {(r.column_a, r.column_b): r.correlation for r in profiling.correlation_matrix(df, ["a", "b", "c"]).collect()}
    expected = df.toPandas().corr()
    assert len(got) == 9
    assert all(math.isclose(v, expected.loc[k[0], k[1]], abs_tol=1e-12) for k, v in got.items())


def test_copies_merge_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"))
    assert profiling.duplicate_counts(df).first()[:] == (1000, 3, 997)
    assert "partial" in plan_of(profiling.duplicate_counts(df))


def _wasserstein(a, b):
    points = np.sort(np.unique(np.concatenate([a, b])))
    f = np.searchsorted(np.sort(a), points, side="right") / len(a)
    g = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return float(np.sum(np.abs(f - g)[:-1] * np.diff(points)))


@pytest.mark.parametrize("ranges", [2, 7, 256])
def test_wasserstein_equals_brute_force_whatever_the_ranges(spark, ranges):
    rng = np.random.default_rng(1)
    a, b = rng.exponential(3, 700).round(2), rng.normal(4, 2, 500).round(2)
    ref = spark.createDataFrame([(float(x),) for x in a], "v double")
    cur = spark.createDataFrame([(float(x),) for x in b] + [(None,)], "v double")
    row = drift.wasserstein(ref, cur, ["v"], ranges).first()
    assert math.isclose(row.value, _wasserstein(a, b) / np.std(a), rel_tol=1e-9)


def test_same_data_does_not_drift(spark):
    df = spark.createDataFrame([(float(i % 7), "ab"[i % 2]) for i in range(100)], "v double, c string")
    report = drift.drift_report(df, df, ["v"], ["c"])
    assert [(r.value, r.drifted) for r in report.collect()] == [(0.0, False)] * 2
    assert drift.check_drift(report).first()[:] == (0.0, False)
    assert drift.check_drift(report.limit(0)).first()["drift"] is False


def test_disjoint_categories(spark):
    one, two = (spark.createDataFrame([(c,)] * 5, "c string") for c in "xy")
    row = drift.jensen_shannon(one, two, ["c"]).first()
    assert math.isclose(row.value, math.sqrt(math.log(2)))


def test_drift_share_is_strict(spark):
    report = spark.createDataFrame([("a", True), ("b", False)], "column_name string, drifted boolean")
    assert drift.check_drift(report, 0.5).first()["drift"] is False
    assert drift.check_drift(report, 0.49).first()["drift"] is True


def test_missing_value_tests(spark):
    ref = spark.createDataFrame([(1.0, "a"), (2.0, None), (3.0, "b"), (4.0, "a")], "v double, c string")
    cur = spark.createDataFrame([(1.0, None), (None, "a"), (3.0, "b")], "v double, c string")
    got = {r.test: (r.value, r.passed) for r in drift.drift_tests(ref, cur, ["v"], ["c"]).collect()}
    assert got["columns_with_missing_values"] == (2.0, False)
    assert got["rows_with_missing_values"] == (2.0, False)
    same = {r.test: r.passed for r in drift.drift_tests(ref, ref, ["v"], ["c"]).collect()}
    assert all(same.values())


def test_no_number_is_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, t string")
    assert rows_of(profiling.missing_counts(df)) == [("t", 1), ("x", 2)]
    assert tuple(drift.missing_summary(df, ["x", "t"]).first()) == (3, 2, 2)


def test_report_keeps_types_apart(spark):
    big = 2**53
    df = spark.createDataFrame(
        [(big, "x", dt.datetime(2024, 1, 1, 0, 0, 0, 5), -0.0), (big + 1, None, None, 0.0), (None, "a", dt.datetime(2023, 1, 1), float("nan"))],
        "n bigint, t string, at timestamp_ntz, d double",
    )
    got = {r.column_name: r for r in profiling.data_quality_report(df, ["n", "t", "at", "d"]).collect()}
    assert (got["n"].distinct_values, got["n"].min_text, got["n"].max_text) == (2, str(big), str(big + 1))
    assert (got["t"].distinct_values, got["t"].missing, got["t"].min_text, got["t"].q50, got["t"].mean) == (2, 1, "a", None, None)
    assert (got["at"].max_text, got["at"].distinct_values) == ("2024-01-01 00:00:00.000005", 2)
    assert (got["d"].distinct_values, got["d"].missing, got["d"].max) == (1, 1, 0.0)
    assert profiling.data_quality_report(df, ["t"]).first().max_text == "x"


def test_a_missed_bracket_is_done_again(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_MARGIN", 0.0)  # no room for the sketch's error
    rng = np.random.default_rng(4)
    values = rng.normal(size=4000)
    df = spark.createDataFrame([(float(v), float(i)) for i, v in enumerate(values)], "x double, y double").repartition(16)
    got = {(r.column_name, r.prob): r.value for r in exact_quantiles(df, ["x", "y"], (0.1, 0.5, 0.93), accuracy=10).collect()}
    for p in (0.1, 0.5, 0.93):
        assert got["x", p] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert got["y", p] == pytest.approx(np.quantile(np.arange(4000), p), rel=1e-12)


@pytest.mark.parametrize("spread", ["even", "exponents", "ties", "infinite"])
def test_ranks_among_many_values_are_found_without_ordering_them(spark, monkeypatch, spread):
    monkeypatch.setattr(quantiles, "MAX_ORDERED", 40)
    rng = random.Random(spread)
    draw = {
        "even": lambda: rng.uniform(-5, 5),
        "exponents": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300),
        "ties": lambda: float(rng.choice([0, 1, rng.random()])),
        "infinite": lambda: rng.choice([math.inf, -math.inf, rng.gauss(0, 1e-3)]),
    }[spread]
    values = [draw() for _ in range(3000)]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "g int, v double")
    probs = (0.0, 0.1, 0.5, 0.9, 1.0)
    got = {(r.g, r.prob): r.value for r in quantiles.exact_quantiles(df, ["v"], probs, ["g"]).collect()}
    for g in (0, 1):
        own = sorted(values[g::2])
        for p in probs:
            at = (len(own) - 1) * p
            low, high = own[math.floor(at)], own[math.ceil(at)]
            want = low + (high - low) * (at - math.floor(at))
            assert got[g, p] == want or math.isnan(want) and math.isnan(got[g, p]) or math.isclose(got[g, p], want, rel_tol=1e-12)
