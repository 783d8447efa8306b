"""Fit several classifiers, choose by validation F1, judge the chosen one on the test rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.operators.learning import (
    COPIES,
    batch_inference,
    classification_report,
    evaluate,
    merged_copies,
    model_results,
    split_stratified,
    top_model,
)
from ridelake.operators.sizing import computed_once


def split_parts(df: DataFrame, key: str, label: str) -> dict[str, DataFrame]:
    # Every fit and every evaluation reads it.
    parted = computed_once(split_stratified(df, key, label))
    return {name: parted.filter(parted["split"] == name).drop("split") for name in ("train", "validation", "test")}


def choose_model(
    df: DataFrame, key: str, columns: Sequence[str], label: str = "label", classifiers: Mapping | None = None
) -> tuple[DataFrame, str, PipelineModel, DataFrame, DataFrame]:
    """Results table, name and model of the best, its test metrics and its test report."""
    parts = split_parts(df, key, label)
    results, models = model_results(parts, columns, classifiers, label)
    results = computed_once(results)
    name = top_model(results).first()["model"]
    scored = batch_inference(models[name], merged_copies(parts["test"], columns, label))
    return results, name, models[name], evaluate(scored, label, copies=COPIES), classification_report(scored, label, copies=COPIES)


def selection_table(df: DataFrame, key: str, columns: Sequence[str], label: str = "label", classifiers: Mapping | None = None) -> DataFrame:
    """The results of all models, which one is ``chosen``, and its metrics on the test rows (null for the others)."""
    results, name, _, test, _ = choose_model(df, key, columns, label, classifiers)
    judged = test.select(F.lit(name).alias("model"), *[F.col(c).alias(f"test_{c}") for c in test.columns])
    return results.withColumn("chosen", F.col("model") == name).join(judged, "model", "left")
