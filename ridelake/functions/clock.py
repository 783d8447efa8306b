"""Time expressions that work alike on TIMESTAMP and TIMESTAMP_NTZ.

``unix_timestamp`` reads a TIMESTAMP_NTZ as it stands, so none of these depend on the
session time zone for such columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def typed_timestamp(schema: T.StructType, name: str) -> Column:
    """The column itself if it is already a timestamp, else its text parsed (null if bad)."""
    if isinstance(schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end."""
    return F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))


def time_chunk(ts: str | Column, seconds: int) -> Column:
    """Number of the fixed-width time chunk that holds ``ts``; never falls as ``ts`` grows."""
    return F.floor(F.unix_timestamp(as_column(ts)) / F.lit(seconds))


def epoch_seconds(text: str | Column) -> Column:
    """Flexible event time, as epoch seconds.

    All digits are epoch seconds, or milliseconds above 1e12; anything else is read as
    ISO-8601 (a trailing ``Z`` included); what cannot be read becomes null.
    """
    trimmed = F.trim(as_column(text))
    digits = F.when(trimmed.rlike("^[0-9]+$"), trimmed.try_cast("bigint"))
    iso = F.unix_micros(F.try_to_timestamp(F.when(~trimmed.rlike("^[0-9]*$"), trimmed)))
    return F.coalesce(
        F.when(digits > 1_000_000_000_000, digits / F.lit(1000.0)).otherwise(digits.cast("double")),
        iso / F.lit(1e6),
    )
