"""Summaries that are computed once, and broadcast only when they have been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.session import shared_folder

MAX_BROADCAST_ROWS = 50_000


def computed_once(df: DataFrame) -> DataFrame:
    """A summary that several later steps read, written to the checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Ask for a broadcast if the table has at most ``max_rows`` rows.

    Meant for narrow summary tables. The summary is computed once, into the checkpoint folder,
    so counting it does not run its plan a second time. Above the limit it comes back as it
    is: the join then shuffles, and adaptive execution splits hot keys.
    """
    kept = computed_once(df)
    return F.broadcast(kept) if kept.limit(max_rows + 1).count() <= max_rows else kept
