"""Registered queries: each over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from ridelake.queries import batch, events, learning, retrieval, statistics, storage, streams
from ridelake.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "batch", "events", "learning", "retrieval", "statistics", "storage", "streams"]
