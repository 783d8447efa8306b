"""Profiles, distributions, outliers, quality and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridelake.functions import rides as rules
from ridelake.operators import drift, profiling
from ridelake.queries.batch import silver_of
from ridelake.queries.registry import QUALITY, SILVER, TRIPS, VECTORS, avg, register, settle
from ridelake.sources.sample_shapes import VECTOR_COLUMNS, labelled_vectors, table, trips

ITEM_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def items(spark, sf):
    return table(spark, sf, "lineitem")


def _each(columns, template: str) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in columns)


def _quantile(column: str, p: float) -> str:
    return f"quantile_cont({column}, {p})"


_DESCRIBE = (
    f"SELECT '{{c}}' AS column_name, count({{c}}) AS count, {avg('{c}', 'mean')}, CAST(CAST(stddev_samp({{c}}) AS FLOAT) AS DOUBLE) AS std, "
    "min({c}) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, "
    "max({c}) AS max FROM lineitem"
)


@register(_each(ITEM_COLUMNS, _DESCRIBE))
def describe(spark, sf):
    return settle(profiling.describe(items(spark, sf), ITEM_COLUMNS), "mean", "std")


@register(
    _each(("event_id", "ts", "value", "props"), "SELECT '{c}' AS column_name, CAST(count(*) FILTER (e.{c} IS NULL) AS BIGINT) AS missing "
    "FROM (SELECT event_id, ts, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value, "
    "CASE WHEN event_type = 'click' THEN NULL ELSE props END AS props FROM events) e")
)
def missing_counts(spark, sf):
    holed = table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "click", F.col("props")).alias("props"),
    )
    return profiling.missing_counts(holed)


@register("SELECT label, count(*) AS count FROM embeddings GROUP BY label ORDER BY label")
def value_counts(spark, sf):
    return profiling.value_counts(labelled_vectors(spark, sf), "label")


@register(
    _each(
        ("l_quantity", "l_extendedprice"),
        "SELECT '{c}' AS column_name, b.bin AS bin, lo + (hi - lo) / 15 * (b.bin - 1) AS bin_start, coalesce(n, 0) AS count "
        "FROM (SELECT CAST(unnest(range(1, 16)) AS INT) AS bin) b CROSS JOIN (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) "
        "LEFT JOIN (SELECT CAST(least(floor(({c} - lo) / (hi - lo) * 15) + 1, 15) AS INT) AS bin, count(*) AS n FROM lineitem, "
        "(SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY 1) h ON h.bin = b.bin",
    )
)
def histogram(spark, sf):
    return profiling.histogram(items(spark, sf), ["l_quantity", "l_extendedprice"])


_BOX = """SELECT l_returnflag, '{c}' AS column_name, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
  min({c}) FILTER ({c} >= q1 - (q3 - q1) * 1.5 AND {c} <= q3 + (q3 - q1) * 1.5) AS whisker_low,
  max({c}) FILTER ({c} >= q1 - (q3 - q1) * 1.5 AND {c} <= q3 + (q3 - q1) * 1.5) AS whisker_high,
  count(*) FILTER (NOT ({c} >= q1 - (q3 - q1) * 1.5 AND {c} <= q3 + (q3 - q1) * 1.5)) AS outliers
  FROM lineitem JOIN (SELECT l_returnflag, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
    quantile_cont({c}, 0.75) AS q3 FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY l_returnflag"""


@register(_each(("l_quantity", "l_extendedprice"), _BOX))
def box_summary(spark, sf):
    return profiling.box_summary(items(spark, sf), ["l_quantity", "l_extendedprice"], "l_returnflag")


@register(
    f"WITH {VECTORS} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 8) AS correlation FROM vectors"
        for a in VECTOR_COLUMNS
        for b in VECTOR_COLUMNS
    )
)
def correlation_matrix(spark, sf):
    cells = profiling.correlation_matrix(labelled_vectors(spark, sf), VECTOR_COLUMNS)
    return cells.withColumn("correlation", F.round("correlation", 8))


_COPIES = "SELECT l_orderkey % 100 AS k, l_linenumber, l_returnflag, l_linestatus FROM lineitem"


def _copies(spark, sf):
    return items(spark, sf).select((F.col("l_orderkey") % 100).alias("k"), "l_linenumber", "l_returnflag", "l_linestatus")


@register(f"SELECT DISTINCT * FROM ({_COPIES})")
def drop_duplicates(spark, sf):
    return profiling.drop_duplicates(_copies(spark, sf))


@register(
    f"""SELECT (SELECT count(*) FROM lineitem) AS rows, count(*) AS distinct_rows,
    (SELECT count(*) FROM lineitem) - count(*) AS removed FROM (SELECT DISTINCT * FROM ({_COPIES}))"""
)
def duplicate_counts(spark, sf):
    return profiling.duplicate_counts(_copies(spark, sf))


_OUT = ("trip_distance", "fare_amount", "total_amount")
_FENCES = ", ".join(
    f"quantile_cont({c}, 0.25) - (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) * 1.5 AS {c}_low, "
    f"quantile_cont({c}, 0.75) + (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) * 1.5 AS {c}_high"
    for c in _OUT
)
_FLAGS = f"""WITH {TRIPS}, fences AS (SELECT {_FENCES} FROM trips),
  flagged AS (SELECT trips.*, {', '.join(f'({c} < {c}_low OR {c} > {c}_high) AS {c}_outlier' for c in _OUT)} FROM trips, fences)"""
_ANY = " OR ".join(f"{c}_outlier" for c in _OUT)


@register(
    _FLAGS
    + _each(_OUT, " SELECT '{c}' AS column_name, count(*) FILTER ({c}_outlier) AS outliers FROM flagged")
    + f" UNION ALL SELECT 'any', count(*) FILTER ({_ANY}) FROM flagged"
)
def iqr_outliers(spark, sf):
    return profiling.iqr_outlier_counts(trips(spark, sf), _OUT)


@register(_FLAGS + f" SELECT VendorID, tpep_pickup_datetime, trip_distance, fare_amount, total_amount, delivery FROM flagged WHERE NOT ({_ANY})")
def iqr_outliers_removed(spark, sf):
    kept = profiling.remove_outliers(trips(spark, sf), _OUT)
    return kept.select("VendorID", "tpep_pickup_datetime", "trip_distance", "fare_amount", "total_amount", "delivery")


_RULES = {
    "fare": "fare_amount >= 0",
    "total": "total_amount >= 0",
    "distance": "trip_distance >= 0",
    "passengers": "passenger_count > 0 AND passenger_count <= 6",
    "free_distance": "NOT (trip_distance = 0 AND fare_amount > 50)",
}


def _share(metric: str, condition: str) -> str:
    return f"SELECT '{metric}' AS metric, CAST(CAST(avg(CAST(({condition}) AS INT)) AS FLOAT) AS DOUBLE) AS value FROM trips"


@register(
    f"WITH {TRIPS} "
    + " UNION ALL ".join(
        [_share(f"null_rate_{k}", f"{k} IS NULL") for k in ("VendorID", "PULocationID", "tpep_pickup_datetime")]
        + [_share(f"removed_by_{name}", f"NOT ({text})") for name, text in _RULES.items()]
        + [_share("removed", f"NOT ({QUALITY})")]
    )
)
def quality_metrics(spark, sf):
    keys = ["VendorID", "PULocationID", "tpep_pickup_datetime"]
    return settle(profiling.quality_metrics(trips(spark, sf), keys), "value")


_SPREAD = ", ".join(
    f"CAST(CAST(quantile_cont({{c}}, {p}) AS FLOAT) AS DOUBLE) AS {name}"
    for name, p in {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}.items()
)


@register(f"WITH {SILVER} " + _each(("speed_mph", "fare_per_mile"), f"SELECT '{{c}}' AS column_name, {_SPREAD} FROM silver"))
def quality_spread(spark, sf):
    return settle(profiling.spread_metrics(silver_of(spark, sf)), "p01", "p25", "p50", "p75", "p99")


_REPORT = (
    f"SELECT '{{c}}' AS column_name, count(*) AS count, count(*) FILTER ({{c}} IS NULL) AS missing, min({{c}}) AS min, "
    f"max({{c}}) AS max, {avg('{c}', 'mean')}, CAST(CAST(stddev_samp({{c}}) AS FLOAT) AS DOUBLE) AS std, count(DISTINCT {{c}}) AS distinct_values, "
    "quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75 FROM lineitem"
)


@register(_each(ITEM_COLUMNS, _REPORT))
def data_quality_report(spark, sf):
    report = profiling.data_quality_report(items(spark, sf), ITEM_COLUMNS)
    return settle(report.drop("min_text", "max_text"), "mean", "std")


@register(
    _each(
        ("event_id", "event_type", "props"),
        "SELECT '{c}' AS column_name, count(*) AS count, count(*) FILTER ({c} IS NULL) AS missing, "
        "CAST(min({c}) AS VARCHAR) AS min_text, CAST(max({c}) AS VARCHAR) AS max_text, count(DISTINCT {c}) AS distinct_values FROM events",
    )
)
def data_quality_report_types(spark, sf):
    """Whole numbers and text, in their own types."""
    report = profiling.data_quality_report(table(spark, sf, "events"), ["event_id", "event_type", "props"])
    return report.select("column_name", "count", "missing", "min_text", "max_text", "distinct_values")


@register(
    "SELECT r_regionkey AS code, r_name AS given, r_name AS name, count(*) AS nations FROM region JOIN nation "
    "ON n_regionkey = r_regionkey GROUP BY 1, 2, 3"
)
def map_labels(spark, sf):
    regions = table(spark, sf, "region")
    names = dict(enumerate(("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")))
    joined = table(spark, sf, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    named = joined.withColumn("name", rules.map_labels("n_regionkey", names))
    return named.groupBy(F.col("r_regionkey").alias("code"), F.col("r_name").alias("given"), "name").agg(
        F.count(F.lit(1)).alias("nations")
    )


@register(
    f"""WITH {VECTORS} SELECT vec_id, f2 * f3 AS petal_area, f0 * f1 AS sepal_area,
    (f2 * f3) / (f0 * f1 + 1e-8) AS petal_sepal_ratio FROM vectors"""
)
def ratio_features(spark, sf):
    made = rules.ratio_features(labelled_vectors(spark, sf), ("f0", "f1"), ("f2", "f3"))
    return made.select("vec_id", "petal_area", "sepal_area", "petal_sepal_ratio")


NUMERIC = ("l_quantity", "l_extendedprice", "l_discount")
CATEGORICAL = ("l_returnflag", "l_linestatus")


def _halves(spark, sf):
    """Earlier shipments as the reference, later and larger ones as the current data."""
    rows = items(spark, sf).withColumn(
        "l_quantity", F.when(F.col("l_shipdate") >= "1998-06-01", F.col("l_quantity") * 1.2).otherwise(F.col("l_quantity"))
    )
    return rows.filter("l_shipdate < '1998-06-01'"), rows.filter("l_shipdate >= '1998-06-01'")


_PARTS = """ref AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01 00:00:00'),
  cur AS (SELECT * REPLACE (l_quantity * 1.2 AS l_quantity) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01 00:00:00')"""


def _distance(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, 'wasserstein_normed' AS statistic, sum(abs(r / rt - k / kt) * step)
      / greatest((SELECT stddev_pop({c}) FROM ref), 0.001) AS value FROM (
      SELECT sum(r) OVER w AS r, sum(k) OVER w AS k, sum(r) OVER () AS rt, sum(k) OVER () AS kt,
        lead(v) OVER (ORDER BY v) - v AS step FROM (
          SELECT v, sum(r) AS r, sum(k) AS k FROM (SELECT {c} AS v, 1 AS r, 0 AS k FROM ref UNION ALL SELECT {c}, 0, 1 FROM cur)
          GROUP BY v) WINDOW w AS (ORDER BY v ROWS UNBOUNDED PRECEDING))"""


def _divergence(c: str) -> str:
    return f"""SELECT '{c}', 'jensen_shannon', sqrt(greatest(0, sum(
        CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2))
      FROM (SELECT r / sum(r) OVER () AS p, k / sum(k) OVER () AS q FROM (
        SELECT v, sum(r) AS r, sum(k) AS k FROM (SELECT {c} AS v, 1 AS r, 0 AS k FROM ref UNION ALL SELECT {c}, 0, 1 FROM cur)
        GROUP BY v))"""


_DRIFT = f"{_PARTS}, drift AS (" + " UNION ALL ".join([_distance(c) for c in NUMERIC] + [_divergence(c) for c in CATEGORICAL]) + ")"


@register(f"WITH {_DRIFT} SELECT column_name, statistic, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, value >= 0.1 AS drifted FROM drift")
def drift_report(spark, sf):
    return settle(drift.drift_report(*_halves(spark, sf), NUMERIC, CATEGORICAL), "value")


@register(
    f"""WITH {_DRIFT} SELECT 'columns_with_missing_values' AS test, CAST(0 AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS bound, TRUE AS passed
    UNION ALL SELECT 'rows_with_missing_values', CAST(count(*) FILTER (l_quantity IS NULL) AS DOUBLE), CAST(0 AS DOUBLE),
      count(*) FILTER (l_quantity IS NULL) <= 0 FROM cur
    UNION ALL SELECT 'drifted_columns', CAST(count(*) FILTER (value >= 0.1) AS DOUBLE), CAST(1 AS DOUBLE),
      count(*) FILTER (value >= 0.1) < 1 FROM drift"""
)
def drift_tests(spark, sf):
    return drift.drift_tests(*_halves(spark, sf), NUMERIC, CATEGORICAL)


@register(
    f"""WITH {_DRIFT} SELECT CAST(CAST(avg(CAST(value >= 0.1 AS INT)) AS FLOAT) AS DOUBLE) AS drifted_share,
    avg(CAST(value >= 0.1 AS INT)) > 0.5 AS drift FROM drift"""
)
def check_drift(spark, sf):
    report = drift.drift_report(*_halves(spark, sf), NUMERIC, CATEGORICAL)
    return settle(drift.check_drift(report), "drifted_share")
