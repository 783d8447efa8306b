"""Running calculations over long ordered groups.

A window partitioned by the key alone puts each key's whole history into one task: with a
handful of vendors, or a zone that holds a third of all rows, that task never ends. Every
function here takes a ``chunk`` expression that never falls along the order and
works in two steps:

1. each (key, chunk) is summarised, with map-side combine, and the short table of
   summaries is accumulated per key;
2. rows get their value within (key, chunk) by an ordinary window, and the accumulated
   summary of the earlier chunks is joined on the same (key, chunk), the partitioning the
   window already has.

Keys must not be null; callers give null keys a name first.

``data_cut`` makes chunks of about equal size from the rows themselves: neither a hot key nor a hot instant of one
puts more rows into a task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CHUNK = "_chunk"

CHUNK_ROWS = 1_000_000
# Sampled rows for each border between chunks, and how many are fetched at most.
SAMPLES_PER_CHUNK = 8
MAX_SAMPLES = 1_000_000


def _sortable(kind: T.DataType, name: str) -> Column:
    """Text whose order is that of a column, nulls first; no such text is the beginning of another."""
    value = F.col(name)
    if isinstance(kind, T.StringType):
        text = F.concat(F.replace(value, F.lit("\0"), F.lit("\0\1")), F.lit("\0\0"))
    else:
        if isinstance(kind, T.TimestampNTZType):
            since = value - F.lit("1970-01-01").cast("timestamp_ntz")
            value = since.cast("interval second").cast("decimal(20,6)") * 1_000_000
        elif isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, T.DateType):
            value = F.unix_date(value)
        elif not isinstance(kind, (T.IntegralType, T.BooleanType)):
            raise TypeError(f"rows are not cut by {name}, which is {kind.simpleString()}")
        # With the sign bit turned, negative numbers come first.
        text = F.lpad(F.hex(value.cast("bigint").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.when(F.col(name).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text))


def data_cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int = CHUNK_ROWS) -> Column:
    """A chunk number that never falls along ``order`` (ascending, nulls first) within a key.

    Chunks hold about ``chunk_rows`` rows of ``df``: their borders are rows, picked by a hash of key and order, the same
    ones however often they are asked for. Only rows equal in all of these share a chunk in any case. Few rows have no
    border, and cost no Python then. Fetched are ``SAMPLES_PER_CHUNK`` short texts for each chunk.
    """
    place = F.concat(F.lpad(F.hex(F.xxhash64(*keys)), 16, "0"), *[_sortable(df.schema[c].dataType, c) for c in order])
    every = max(1, chunk_rows // SAMPLES_PER_CHUNK)
    while True:
        picked = df.select(place.alias("place")).filter(F.pmod(F.xxhash64("place"), F.lit(every)) == 0)
        places = sorted(r.place for r in picked.limit(MAX_SAMPLES + 1).collect())
        if len(places) <= MAX_SAMPLES:
            break
        every *= 2
    borders = places[SAMPLES_PER_CHUNK - 1 :: SAMPLES_PER_CHUNK]
    if not borders:
        return F.lit(0)

    def chunk_of(own: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(borders, x) for x in own], dtype="int32")

    return F.pandas_udf(chunk_of, T.IntegerType())(place)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    chunk: Column,
    totals: Mapping[str, Column],
    inclusive: bool = False,
) -> DataFrame:
    """Add, per key and along ``order``, the running sum of each expression in ``totals``.

    The current row counts only if ``inclusive``. ``order`` must be total for a
    reproducible result.
    """
    part = [*keys, _CHUNK]
    chunked = df.withColumn(_CHUNK, chunk)
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*part)
        .agg(*[F.sum(expr).alias(f"_sum_{name}") for name, expr in totals.items()])
        .select(*part, *[F.sum(f"_sum_{name}").over(before).alias(f"_off_{name}") for name in totals])
    )
    within = (
        Window.partitionBy(*part)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    inner = chunked.withColumns({f"_in_{name}": F.sum(expr).over(within) for name, expr in totals.items()})
    summed = {
        name: F.coalesce(F.col(f"_off_{name}"), F.lit(0)) + F.coalesce(F.col(f"_in_{name}"), F.lit(0))
        for name in totals
    }
    helpers = [_CHUNK] + [f"_{kind}_{name}" for kind in ("in", "off") for name in totals]
    return inner.join(offsets, part, "left").withColumns(summed).drop(*helpers)


def running_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], chunk: Column, name: str
) -> DataFrame:
    """Row number from 1 per key along ``order``."""
    return running_totals(df, keys, order, chunk, {name: F.lit(1)}, inclusive=True)


def carry_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    value: str,
    name: str,
) -> DataFrame:
    """Add the newest non-null ``value`` at or before each row, per key along ``order``."""
    return carry_each(df, keys, order, chunk, {name: value})


def carry_each(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, values: Mapping[str, str]) -> DataFrame:
    """``carry_last`` of several columns in one pass: ``values`` names the column each new one carries."""
    part = [*keys, _CHUNK]
    chunked = df.withColumn(_CHUNK, chunk)
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    newest = {
        name: F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias(f"_newest_{name}") for name, value in values.items()
    }
    carried = (
        chunked.groupBy(*part)
        .agg(*newest.values())
        .select(*part, *[F.last(f"_newest_{name}", ignorenulls=True).over(before).alias(f"_carried_{name}") for name in values])
    )
    within = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = chunked.withColumns({f"_inner_{name}": F.last(value, ignorenulls=True).over(within) for name, value in values.items()})
    found = {name: F.coalesce(f"_inner_{name}", f"_carried_{name}") for name in values}
    helpers = [f"_{kind}_{name}" for kind in ("inner", "carried") for name in values]
    return inner.join(carried, part, "left").withColumns(found).drop(*helpers, _CHUNK)
