"""Descriptive statistics, distributions and data-quality counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.operators.quantiles import QUARTILES, numeric, quantile_columns
from ridelake.operators.silver import QUALITY_RULES, all_rules
from ridelake.operators.sizing import broadcast_if_small

BINS = 15
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
WHISKER = 1.5


def per_column(df: DataFrame, columns: Sequence[str], measures: Mapping[str, "callable"]) -> DataFrame:
    """Rows (column_name, measures..) from one aggregation over all columns at once."""
    wide = df.agg(
        *[
            F.struct(F.lit(c).alias("column_name"), *[make(c).alias(name) for name, make in measures.items()]).alias(
                f"_{i}"
            )
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


def column_map(long: DataFrame, value: Column) -> Column:
    """A table with one row per column name as a scalar map, for use in any row's expression."""
    return long.agg(F.map_from_entries(F.collect_list(F.struct("column_name", value)))).scalar()


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each column."""
    moments = per_column(
        df,
        columns,
        {
            "count": lambda c: F.count(numeric(c)),
            "mean": lambda c: F.avg(numeric(c)),
            "std": lambda c: F.stddev_samp(numeric(c)),
            "min": lambda c: F.min(numeric(c)),
            "max": lambda c: F.max(numeric(c)),
        },
    )
    quartiles = quantile_columns(df, columns, dict(zip(("q25", "q50", "q75"), QUARTILES)))
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def missing(df: DataFrame, column: str) -> Column:
    """Whether a value is null, or no number in a column of floating-point numbers."""
    value = F.col(column)
    return value.isNull() | F.isnan(value) if dict(df.dtypes)[column] in ("float", "double") else value.isNull()


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return per_column(
        df, columns or df.columns, {"missing": lambda c: F.count_if(missing(df, c))}
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per class, by class; rows without one are left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(column)
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """Equal-width bins per column, empty ones included; the maximum falls in the last bin.

    A constant column gets bins from half below to half above its value.
    """
    extent = per_column(
        df, columns, {"lo": lambda c: F.min(numeric(c)), "hi": lambda c: F.max(numeric(c))}
    ).select(
        "column_name",
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    limits = column_map(extent, F.struct("lo", "hi"))
    entries = []
    for column in columns:
        value, limit = numeric(column), F.col("_limits")[column]
        place = F.floor((value - limit["lo"]) / (limit["hi"] - limit["lo"]) * F.lit(bins)) + 1
        held = F.when(value.isNotNull(), F.least(place, F.lit(bins)).cast("int"))
        entries.append(F.struct(F.lit(column).alias("column_name"), held.alias("bin")))
    counted = (
        df.select(*columns)
        .withColumn("_limits", limits)
        .select(F.inline(F.array(*entries)))
        .filter("bin IS NOT NULL")
        .groupBy("column_name", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    edges = extent.filter("lo IS NOT NULL").select(
        "column_name",
        "lo",
        width.alias("width"),
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"),
    )
    return edges.join(counted, ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        (F.col("lo") + F.col("width") * (F.col("bin") - 1)).alias("bin_start"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def box_summary(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Per class and column: quartiles, whiskers and how many values lie beyond them.

    Whiskers end at the outermost values within 1.5 interquartile ranges of the box. Rows
    of no class are left out.
    """
    classed = df.filter(F.col(by).isNotNull()).select(by, *columns)
    names = dict(zip(("q1", "median", "q3"), QUARTILES))
    boxes = quantile_columns(classed, columns, names, [by])
    boxes_of = boxes.groupBy(by).agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", F.struct(*names)))).alias("_boxes")
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), numeric(c).alias("value"), F.col("_boxes")[c].alias("box"))
        for c in columns
    ]
    value, box = F.col("value"), F.col("box")
    reach = (box["q3"] - box["q1"]) * F.lit(WHISKER)
    within = (value >= box["q1"] - reach) & (value <= box["q3"] + reach)
    return (
        classed.join(broadcast_if_small(boxes_of), by)
        .select(by, F.inline(F.array(*entries)))
        .filter("value IS NOT NULL")
        .groupBy(by, "column_name")
        .agg(
            F.first(box["q1"]).alias("q1"),
            F.first(box["median"]).alias("median"),
            F.first(box["q3"]).alias("q3"),
            F.min(F.when(within, value)).alias("whisker_low"),
            F.max(F.when(within, value)).alias("whisker_high"),
            F.count_if(~within).alias("outliers"),
        )
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, over the rows that have both, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(numeric(a), numeric(b)).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(
                F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"_{i}").alias("correlation"))
            )
    return wide.select(F.inline(F.array(*cells)))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Each distinct row once; copies are merged in the map tasks, before the shuffle."""
    return df.dropDuplicates()


def duplicate_counts(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and rows that dropping duplicates removes."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("removed", F.col("rows") - F.col("distinct_rows"))


def iqr_fences(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column_name, low, high): 1.5 interquartile ranges beyond the quartiles."""
    boxes = quantile_columns(df, columns, {"q1": 0.25, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * F.lit(WHISKER)
    return boxes.select("column_name", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))


def flag_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``is_outlier``, true if any column lies beyond its fences, and one flag per column."""
    limits = column_map(iqr_fences(df, columns), F.struct("low", "high"))
    flagged = df.withColumn("_limits", limits)
    flags = {}
    for column in columns:
        value, limit = numeric(column), F.col("_limits")[column]
        beyond = (value < limit["low"]) | (value > limit["high"])
        flags[f"{column}_outlier"] = F.coalesce(beyond, F.lit(False))
    flagged = flagged.withColumns(flags).drop("_limits")
    return flagged.withColumn("is_outlier", F.greatest(*[F.col(name) for name in flags]))


def iqr_outlier_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Outliers per column, and under ``any`` the rows flagged in at least one."""
    flagged = flag_outliers(df, columns)
    totals = flagged.agg(
        *[F.count_if(F.col(f"{c}_outlier")).alias(c) for c in columns], F.count_if("is_outlier").alias("any")
    )
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("outliers")) for c in (*columns, "any")]
    return totals.select(F.inline(F.array(*cells)))


def remove_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return flag_outliers(df, columns).filter("NOT is_outlier").select(*df.columns)


def quality_metrics(
    df: DataFrame, keys: Sequence[str], rules: Mapping[str, str] = QUALITY_RULES
) -> DataFrame:
    """Rows (metric, value): null rate per key, share removed per rule and by all together."""
    shares = {f"null_rate_{k}": F.col(k).isNull() for k in keys}
    shares |= {f"removed_by_{name}": ~F.coalesce(F.expr(text), F.lit(False)) for name, text in rules.items()}
    shares["removed"] = ~F.coalesce(all_rules(rules), F.lit(False))
    wide = df.agg(*[F.avg(held.cast("int")).alias(name) for name, held in shares.items()])
    cells = [F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name in shares]
    return wide.select(F.inline(F.array(*cells)))


def spread_metrics(df: DataFrame, columns: Sequence[str] = ("speed_mph", "fare_per_mile")) -> DataFrame:
    """1st, 25th, 50th, 75th and 99th percentile of the derived columns, to watch for outliers."""
    names = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    return quantile_columns(df, columns, names)


def data_quality_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, missing, distinct, minimum, maximum, mean, deviation and quartiles.

    ``min_text``, ``max_text`` and the distinct values are those of the column's own type, so whole
    numbers of any size, text and times are exact; the other statistics are of numbers, and null for
    columns of other types. Distinct values are merged before the shuffle.
    """
    kinds = dict(df.dtypes)
    numbers = [c for c in columns if kinds[c].startswith("decimal") or kinds[c] in NUMBERS]

    def number(c: str) -> Column:
        return numeric(c) if c in numbers else F.lit(None).cast("double")

    def own(c: str) -> Column:
        # A negative zero is a zero, and not-a-number is no value.
        return numeric(c) + F.lit(0.0) if kinds[c] in ("float", "double") else F.col(c)

    basics = per_column(
        df,
        columns,
        {
            "count": lambda c: F.count(F.lit(1)),
            "missing": lambda c: F.count_if(missing(df, c)),
            "min": lambda c: F.min(number(c)),
            "max": lambda c: F.max(number(c)),
            "mean": lambda c: F.avg(number(c)),
            "std": lambda c: F.stddev_samp(number(c)),
            "min_text": lambda c: F.min(own(c)).cast("string"),
            "max_text": lambda c: F.max(own(c)).cast("string"),
        },
    )
    cells = [F.struct(F.lit(c).alias("column_name"), own(c).cast("string").alias("value")) for c in columns]
    distinct = (
        df.select(F.inline(F.array(*cells)))
        .filter("value IS NOT NULL")
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("distinct_values"))
    )
    names = dict(zip(("q25", "q50", "q75"), QUARTILES))
    if numbers:
        quartiles = quantile_columns(df, numbers, names)
    else:
        quartiles = basics.limit(0).select("column_name", *[F.lit(None).cast("double").alias(n) for n in names])
    return (
        basics.join(distinct, "column_name", "left")
        .join(quartiles, "column_name", "left")
        .withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))
    )


def gold_freshness(df: DataFrame, as_of: Column, updated: str = "gold_updated_at", hours: int = 24) -> DataFrame:
    """Newest update, and whether it lies within the given hours before ``as_of``."""
    bound = as_of - F.make_dt_interval(hours=F.lit(hours))
    return df.agg(F.max(updated).alias("newest")).withColumn(
        "fresh", F.coalesce(F.col("newest") >= bound, F.lit(False))
    )


def feature_range_check(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows (feature, violations, passed): values outside the inclusive bounds; nulls are not counted."""

    def outside(column: str) -> Column:
        low, high = bounds[column]
        value, broken = F.col(column), F.lit(False)
        if low is not None:
            broken = broken | (value < F.lit(low))
        if high is not None:
            broken = broken | (value > F.lit(high))
        return F.count_if(broken)

    checked = per_column(df, list(bounds), {"violations": outside}).withColumnRenamed("column_name", "feature")
    return checked.withColumn("passed", F.col("violations") == 0)


