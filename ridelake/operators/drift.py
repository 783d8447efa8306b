"""Drift between a reference table and a current one, and data-quality tests.

For large data the adopted statistics are the normed Wasserstein distance for numeric columns
and the Jensen-Shannon distance for categorical ones, both drifted from 0.1 on.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.operators.profiling import column_map, missing, per_column
from ridelake.operators.quantiles import numeric

THRESHOLD = 0.1
# Smallest deviation the Wasserstein distance is divided by.
MIN_NORM = 0.001
# One task accumulates a range: about so many rows of a column, and at least so many ranges. Their borders are fetched.
ROWS_PER_RANGE = 250_000
MIN_RANGES, MAX_RANGES = 64, 16_384


def _both(reference: DataFrame, current: DataFrame, columns: Sequence[str], cell) -> DataFrame:
    """Cells of both tables, marked by the table they come from."""
    picked = [cell(c).alias(c) for c in columns]
    return (
        reference.select(*picked)
        .withColumn("is_reference", F.lit(True))
        .unionByName(current.select(*picked).withColumn("is_reference", F.lit(False)))
    )


def _value_counts(both: DataFrame, columns: Sequence[str], *extra: str) -> DataFrame:
    """Rows (column_name, extra.., value, ref_n, cur_n); equal values merge before the shuffle.

    ``extra`` names attributes of a cell, each kept in a column called ``column_attribute``.
    """
    cells = [
        F.struct(
            F.lit(c).alias("column_name"), *[F.col(f"{c}_{x}").alias(x) for x in extra], F.col(c).alias("value")
        )
        for c in columns
    ]
    return (
        both.select(F.inline(F.array(*cells)), "is_reference")
        .filter("value IS NOT NULL")
        .groupBy("column_name", *extra, "value")
        .agg(F.count_if("is_reference").alias("ref_n"), F.count_if(~F.col("is_reference")).alias("cur_n"))
    )


def _ranged(both: DataFrame, columns: Sequence[str], ranges: int) -> DataFrame:
    """Add ``column_range``: the range of each value between sketched quantiles of both tables.

    The cuts, at most ``ranges`` numbers a column, are fetched once and become part of the plan.
    """
    steps = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = both.agg(*[F.percentile_approx(c, steps, F.lit(4 * ranges)).alias(c) for c in columns]).first()
    splits = [[-math.inf, *(sorted(set(cuts[c] or [])) or [0.0]), math.inf] for c in columns]
    cutter = Bucketizer(
        splitsArray=splits,
        inputCols=list(columns),
        outputCols=[f"{c}_range" for c in columns],
        handleInvalid="keep",
    )
    return cutter.transform(both)


def wasserstein(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """Area between the two distribution functions, over the reference's population deviation.

    The values are cut into ranges at sketched quantiles, as many as the number of rows asks for if not given. Each range is accumulated on its
    own; the totals of the lower ranges, and the first value of the next, come from the
    short table of ranges.
    """
    both = _both(reference, current, columns, numeric)
    if ranges is None:
        ranges = min(MAX_RANGES, max(MIN_RANGES, both.count() // ROWS_PER_RANGE))
    ranged = _value_counts(_ranged(both, columns, ranges), columns, "range")

    part = ["column_name", "range"]
    ordered = Window.partitionBy("column_name").orderBy("range")
    lower = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("column_name")
    totals = (
        ranged.groupBy(*part)
        .agg(F.sum("ref_n").alias("r"), F.sum("cur_n").alias("c"), F.min("value").alias("first_value"))
        .select(
            *part,
            F.coalesce(F.sum("r").over(lower), F.lit(0)).alias("ref_below"),
            F.coalesce(F.sum("c").over(lower), F.lit(0)).alias("cur_below"),
            F.sum("r").over(whole).alias("ref_total"),
            F.sum("c").over(whole).alias("cur_total"),
            F.lead("first_value").over(ordered).alias("next_range_value"),
        )
    )
    within = Window.partitionBy(*part).orderBy("value")
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumns(
        {
            "ref_upto": F.sum("ref_n").over(upto),
            "cur_upto": F.sum("cur_n").over(upto),
            "next_value": F.lead("value").over(within),
        }
    ).join(totals, part)
    apart = F.abs(
        F.try_divide(F.col("ref_below") + F.col("ref_upto"), F.col("ref_total"))
        - F.try_divide(F.col("cur_below") + F.col("cur_upto"), F.col("cur_total"))
    )
    step = F.coalesce("next_value", "next_range_value") - F.col("value")
    area = placed.groupBy("column_name").agg(F.coalesce(F.sum(apart * step), F.lit(0.0)).alias("area"))
    norm = per_column(reference, columns, {"deviation": lambda c: F.stddev_pop(numeric(c))})
    return area.join(norm, "column_name").select(
        "column_name",
        F.lit("wasserstein_normed").alias("statistic"),
        (F.col("area") / F.greatest("deviation", F.lit(MIN_NORM))).alias("value"),
    )


def jensen_shannon(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance of the category shares: root of the divergence, natural logarithm."""
    both = _both(reference, current, columns, lambda c: F.col(c).cast("string"))
    counts = _value_counts(both, columns)
    totals = column_map(
        counts.groupBy("column_name").agg(F.sum("ref_n").alias("r"), F.sum("cur_n").alias("c")), F.struct("r", "c")
    )
    total = F.col("_totals")[F.col("column_name")]
    shares = counts.withColumn("_totals", totals).select(
        "column_name", F.try_divide("ref_n", total["r"]).alias("p"), F.try_divide("cur_n", total["c"]).alias("q")
    )
    middle = (F.col("p") + F.col("q")) / 2

    def term(share: str):
        return F.when(F.col(share) > 0, F.col(share) * F.log(F.col(share) / middle)).otherwise(0.0)

    divergence = F.sum(term("p") + term("q")) / 2
    return shares.groupBy("column_name").agg(
        F.lit("jensen_shannon").alias("statistic"), F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("value")
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    numeric_columns: Sequence[str] = (),
    categorical_columns: Sequence[str] = (),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Rows (column_name, statistic, value, drifted)."""
    parts = []
    if numeric_columns:
        parts.append(wasserstein(reference, current, numeric_columns))
    if categorical_columns:
        parts.append(jensen_shannon(reference, current, categorical_columns))
    if not parts:
        raise ValueError("name at least one column")
    report = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return report.withColumn("drifted", F.col("value") >= threshold)


def missing_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, columns with a missing value, and rows with one."""
    absent = [missing(df, c) for c in columns]
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.greatest(*absent, F.lit(False))).alias("rows_missing"),
        *[F.max(flag.cast("int")).alias(f"_{i}") for i, flag in enumerate(absent)],
    )
    columns_missing = sum((F.coalesce(F.col(f"_{i}"), F.lit(0)) for i in range(len(columns))), F.lit(0))
    return wide.select("rows", "rows_missing", columns_missing.cast("bigint").alias("columns_missing"))


def drift_tests(
    reference: DataFrame,
    current: DataFrame,
    numeric_columns: Sequence[str] = (),
    categorical_columns: Sequence[str] = (),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Rows (test, value, bound, passed).

    Adopted bounds: no more columns with missing values than the reference has; no more rows
    with missing values than 1.1 times the reference's share; fewer than a third of the columns
    drifted.
    """
    columns = [*numeric_columns, *categorical_columns]
    before = missing_summary(reference, columns).select(
        *[F.col(c).alias(f"ref_{c}") for c in ("rows", "rows_missing", "columns_missing")]
    )
    drifted = drift_report(reference, current, numeric_columns, categorical_columns, threshold).agg(
        F.count_if("drifted")
    )
    both = missing_summary(current, columns).withColumns(
        {"_before": before.select(F.struct("*")).scalar(), "_drifted": drifted.scalar()}
    )
    share = F.try_divide("_before.ref_rows_missing", "_before.ref_rows")
    rows_bound = F.coalesce(share, F.lit(0.0)) * F.lit(1.1) * F.col("rows")
    drift_bound = float(max(len(columns) // 3, 1))

    def row(name, value, bound, passed):
        value, bound = value.cast("double"), bound.cast("double")
        return F.struct(
            F.lit(name).alias("test"), value.alias("value"), bound.alias("bound"), passed(value, bound).alias("passed")
        )

    cells = F.array(
        row("columns_with_missing_values", F.col("columns_missing"), F.col("_before.ref_columns_missing"), lambda v, b: v <= b),
        row("rows_with_missing_values", F.col("rows_missing"), rows_bound, lambda v, b: v <= b),
        row("drifted_columns", F.col("_drifted"), F.lit(drift_bound), lambda v, b: v < b),
    )
    return both.select(F.inline(cells))


def check_drift(report: DataFrame, share: float = 0.5) -> DataFrame:
    """One row: the drifted share, and whether it exceeds ``share``; no columns is no drift."""
    return report.agg(F.avg(F.col("drifted").cast("int")).alias("drifted_share")).withColumn(
        "drift", F.coalesce(F.col("drifted_share") > share, F.lit(False))
    )
