"""Prediction events: flagged by score and counted by result, on tables and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions.scoring import ANOMALY_SCORE, anomaly_result


def flag_predictions(events: DataFrame, threshold: float = ANOMALY_SCORE) -> DataFrame:
    """Add ``result`` (anomaly or normal) and ``is_anomaly``; a missing score counts as 0."""
    return events.withColumn("result", anomaly_result("prediction_score", threshold)).withColumn(
        "is_anomaly", F.col("result") == "anomaly"
    )


def prediction_counts(events: DataFrame, threshold: float = ANOMALY_SCORE) -> DataFrame:
    return flag_predictions(events, threshold).groupBy("result").agg(F.count(F.lit(1)).alias("events"))
