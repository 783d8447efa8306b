"""Row counts of the stages of a job, taken while it runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StageCounts:
    """Counts rows that pass named points of a plan, in the one action that runs the plan.

    A point must be passed by one action only: further actions are not added up.
    """

    def __init__(self) -> None:
        self._points: dict[str, Observation] = {}

    def mark(self, df: DataFrame, stage: str) -> DataFrame:
        self._points[stage] = Observation(stage)
        return df.observe(self._points[stage], F.count(F.lit(1)).alias("rows"))

    def get(self) -> dict[str, int]:
        """Rows per stage. Waits for the action, so run it first."""
        return {stage: point.get["rows"] for stage, point in self._points.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.get().items()), "stage string, row_count bigint")
