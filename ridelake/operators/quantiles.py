"""Exact quantiles without gathering a column.

``percentile`` keeps every distinct value of a group in one buffer. Here a sketch, of fixed
size, first brackets each wanted rank; then one more pass counts what lies below the bracket
and the distinct values inside it. Only values inside a bracket, a share of all rows set by
``accuracy``, are ever ordered. The bracket is checked: columns where one missed its rank are
done again with a finer sketch, until, at the latest, all values of a group fit in it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.operators.sizing import broadcast_if_small, computed_once

QUARTILES = (0.25, 0.5, 0.75)

# So many distinct values of a group are put in order by one task; more are first counted in so many ranges.
MAX_ORDERED = 100_000
PARTS = 64
ACCURACY = 20_000
FINER = 16

# Sketch ranks are off by at most n / accuracy; the bracket leaves four times that. Of a group
# with fewer values than that is sure for, ``accuracy`` at most, all values are kept.
_MARGIN = 4.0


def numeric(column: str) -> Column:
    """The column as double, not-a-number counting as missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _fences(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str], accuracy: int):
    """One struct per column: how many values, and the bracket of each wanted rank."""
    reach = _MARGIN / accuracy
    low, high = [p - reach for p in probs], [p + reach for p in probs]
    wanted = [min(max(p, 0.0), 1.0) for p in (*low, *high)]
    made = []
    for column in columns:
        value = F.col(column)
        cuts = F.percentile_approx(value, F.array(*map(F.lit, wanted)), F.lit(accuracy))
        few = F.count(value) <= accuracy
        lows = [
            F.min(value) if p <= 0 else F.when(few, F.min(value)).otherwise(F.get(cuts, F.lit(i)))
            for i, p in enumerate(low)
        ]
        highs = [
            F.max(value) if p >= 1 else F.when(few, F.max(value)).otherwise(F.get(cuts, F.lit(len(probs) + i)))
            for i, p in enumerate(high)
        ]
        made.append(
            F.struct(
                F.count(value).alias("n"), F.array(*lows).alias("low"), F.array(*highs).alias("high")
            ).alias(column)
        )
    return df.groupBy(*by).agg(F.struct(*made).alias("_fence"))


def _constant(fence) -> dict:
    return {"n": fence["n"], "low": fence["low"], "high": fence["high"]}


def _bound(fence: dict | Column, side: str, i: int) -> Column:
    """The i-th bracket's lower or upper end."""
    return F.lit(fence[side][i]).cast("double") if isinstance(fence, dict) else fence[side][i]


def _as_struct(fence: dict | Column, count: int) -> Column:
    if not isinstance(fence, dict):
        return fence
    ends = [F.array(*[_bound(fence, side, i) for i in range(count)]).alias(side) for side in ("low", "high")]
    return F.struct(F.lit(fence["n"]).cast("bigint").alias("n"), *ends)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = QUARTILES,
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Rows (by.., column_name, prob, value), interpolated linearly between neighbours.

    ``probs`` rise; ``by`` columns must not be null.
    """
    narrow = df.select(*by, *[numeric(c).alias(c) for c in columns])
    fences = _fences(narrow, columns, probs, by, accuracy)
    if by:
        fences = broadcast_if_small(fences)
        known = {c: F.col(f"_fence.{c}") for c in columns}
    else:
        # Two numbers per column and rank: they are fetched, and are constants of the next pass.
        found = fences.first()["_fence"]
        known = {c: _constant(found[c]) for c in columns}

    def fenced(rows: DataFrame) -> DataFrame:
        return rows.join(fences, list(by)) if by else rows

    # Each value is either inside a bracket, and kept, or only counted, under the number of
    # brackets that begin at or below it.
    entries = []
    for column in columns:
        value, fence = F.col(column), known[column]
        inside, passed = F.lit(False), F.lit(0)
        for i in range(len(probs)):
            begun = value >= _bound(fence, "low", i)
            inside = inside | (begun & (value <= _bound(fence, "high", i)))
            passed = passed + F.when(begun, 1).otherwise(0)
        entries.append(
            F.struct(
                F.lit(column).alias("column_name"),
                F.when(inside, value).alias("value"),
                F.when(~inside, passed).alias("passed"),
            )
        )
    counted = (
        fenced(narrow)
        .select(*by, F.inline(F.array(*entries)))
        .filter("value IS NOT NULL OR passed IS NOT NULL")
        .groupBy(*by, "column_name", "value", "passed")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )

    # From here on only counts: every entry serves each rank whose bracket does not end below it.
    fence = F.coalesce(*[F.when(F.col("column_name") == c, _as_struct(known[c], len(probs))) for c in columns])
    ranks = []
    for i, prob in enumerate(probs):
        low, high = F.col("_own.low")[i], F.col("_own.high")[i]
        below = (F.col("passed") <= i) | (F.col("value") < low)
        counts = below | (F.col("value") <= high)
        ranks.append(
            F.struct(
                F.when(F.coalesce(counts, F.lit(False)), F.lit(float(prob))).alias("prob"),
                F.when(~F.coalesce(below, F.lit(False)), F.col("value")).alias("value"),
            )
        )
    group = [*by, "column_name", "prob", "n"]
    placed = (
        fenced(counted)
        .withColumn("_own", fence)
        .select(*by, "column_name", F.col("_own.n").alias("n"), "_rows", F.inline(F.array(*ranks)))
        .filter("prob IS NOT NULL")
        .groupBy(*group, "value")
        .agg(F.sum("_rows").alias("_rows"))
    )
    rank = (F.col("n") - 1) * F.col("prob")
    picked = select_ranks(computed_once(placed), group)
    bracketed = (F.col("_below") <= F.floor(rank)) & F.col("_upper").isNotNull()
    between = F.col("_lower") + (F.col("_upper") - F.col("_lower")) * (rank - F.floor(rank))
    found = computed_once(picked.select(*by, "column_name", "prob", between.alias("value"), bracketed.alias("_held")))
    missed = [r.column_name for r in found.filter("NOT _held").select("column_name").distinct().collect()]
    kept = found.filter(~F.col("column_name").isin(missed)).drop("_held")
    if not missed:
        return kept
    again = exact_quantiles(df, [c for c in columns if c in missed], probs, by, accuracy * FINER)
    return kept.unionByName(again)


def select_ranks(placed: DataFrame, group: Sequence[str]) -> DataFrame:
    """``group.., _below, _lower, _upper``: what lies below the bracket, and the values at both sides of the rank.

    ``placed`` counts ``_rows`` for each distinct ``value`` of a group; a null value counts what lies below the bracket. No group
    is put in order while more than ``MAX_ORDERED`` of its values are left: they are counted in ``PARTS`` ranges between sketched
    quantiles of these values, and those in the range that holds the rank go on: about one in ``PARTS``, whatever the values.
    """
    rank = (F.col("n") - 1) * F.col("prob")
    below = F.sum(F.when(F.col("value").isNull(), F.col("_rows")).otherwise(0))
    side = F.explode(F.array(F.struct(F.lit("_lower").alias("side"), F.floor(rank).alias("at")), F.struct(F.lit("_upper").alias("side"), F.ceil(rank).alias("at"))))
    one = [*group, "side"]
    left = placed.filter("value IS NOT NULL").select(*group, "value", "_rows", side.alias("_s")).select(*group, "value", "_rows", "_s.side", "_s.at")
    # Rows of a group below the values still looked at.
    base = placed.groupBy(*group).agg(below.alias("_below"))
    left = left.join(base, list(group)).withColumnRenamed("_below", "_before")
    found = []
    while True:
        cuts = F.percentile_approx("value", F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)]), F.lit(100 * PARTS))
        sizes = left.groupBy(*one).agg(F.count(F.lit(1)).alias("_distinct"), cuts.alias("_cuts"))
        most = sizes.agg(F.max("_distinct")).first()[0]
        if most is None or most <= MAX_ORDERED:
            found.append(_in_order(left, one))
            break
        sizes = computed_once(sizes)
        few, many = sizes.filter(F.col("_distinct") <= MAX_ORDERED), sizes.filter(F.col("_distinct") > MAX_ORDERED)
        found.append(_in_order(left.join(few.select(*one), one), one))
        left = computed_once(_narrowed(left.join(many, one), one))
    values = reduce(DataFrame.unionByName, found)
    sides = values.groupBy(*group).agg(*[F.max(F.when(F.col("side") == s, F.col("_value"))).alias(s) for s in ("_lower", "_upper")])
    return base.join(sides, list(group), "left")


def _in_order(left: DataFrame, one: Sequence[str]) -> DataFrame:
    """The value at the wanted place of every group, by an ordered sum over its few values."""
    upto = Window.partitionBy(*one).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reached = left.withColumn("_upto", F.col("_before") + F.sum("_rows").over(upto))
    return reached.groupBy(*one).agg(F.min(F.when(F.col("_upto") > F.col("at"), F.col("value"))).alias("_value"))


def _narrowed(left: DataFrame, one: Sequence[str]) -> DataFrame:
    """Values of the range that holds the wanted place, and how many rows lie before them."""
    part = F.size(F.filter("_cuts", lambda cut: cut < F.col("value")))
    parted = left.withColumn("_part", part)
    before = Window.partitionBy(*one).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parted.groupBy(*one, "_part").agg(F.sum("_rows").alias("_sum"), F.first("at").alias("_at"), F.first("_before").alias("_start"))
    sums = sums.withColumn("_start", F.col("_start") + F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    # A place beyond all values, of a bracket that missed its rank, has no range and drops out.
    holds = sums.filter((F.col("_start") <= F.col("_at")) & (F.col("_at") < F.col("_start") + F.col("_sum"))).select(*one, "_part", "_start")
    kept = parted.join(holds, [*one, "_part"])
    return kept.withColumn("_before", F.col("_start")).drop("_part", "_start", "_distinct", "_cuts")


def quantile_columns(
    df: DataFrame,
    columns: Sequence[str],
    names: dict[str, float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Rows (by.., column_name, one column per name): the quantiles side by side."""
    long = exact_quantiles(df, columns, tuple(names.values()), by, accuracy)
    return long.groupBy(*by, "column_name").agg(
        *[F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(name) for name, p in names.items()]
    )
