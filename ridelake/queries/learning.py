"""Labels, splits, scaling, models, metrics and fixed scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridelake.functions import scoring
from ridelake.operators import learning as ml
from ridelake.operators.sizing import computed_once
from ridelake.plans import model_choice
from ridelake.queries.registry import SCORED, VECTORS, register, settle
from ridelake.session import scratch_path
from ridelake.sources.sample_shapes import (
    RIDE_FEATURES,
    VECTOR_COLUMNS,
    labelled_rides,
    labelled_vectors,
    measured_items,
    table,
)


@register(
    """SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS DOUBLE) AS label FROM customer"""
)
def label_encode(spark, sf):
    return ml.label_encode(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")


_PLACE = "row_number() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey)"


@register(
    f"""SELECT o_orderkey, CASE WHEN place <= floor(round(n * 0.8, 6)) THEN 'train' ELSE 'test' END AS split
    FROM (SELECT o_orderkey, {_PLACE} AS place, count(*) OVER () AS n FROM orders)"""
)
def split_random(spark, sf):
    return ml.split_random(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


_CLASS_PLACE = "row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey)"


@register(
    f"""SELECT o_orderkey, o_orderpriority, CASE WHEN place <= floor(round(n * 0.6, 6)) THEN 'train'
      WHEN place <= floor(round(n * 0.8, 6)) THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT o_orderkey, o_orderpriority, {_CLASS_PLACE} AS place, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)"""
)
def split_stratified(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return ml.split_stratified(rows, "o_orderkey", "o_orderpriority").select("o_orderkey", "o_orderpriority", "split")


def _scaled(c: str) -> str:
    return f"CAST(CAST(({c} - (SELECT avg({c}) FROM fit)) / (SELECT stddev_pop({c}) FROM fit) AS FLOAT) AS DOUBLE) AS {c}"


@register(
    f"""WITH {VECTORS}, fit AS (SELECT * FROM vectors WHERE vec_id % 5 < 3)
    SELECT vec_id, {', '.join(_scaled(c) for c in VECTOR_COLUMNS)} FROM vectors"""
)
def standard_scale(spark, sf):
    rows = labelled_vectors(spark, sf).drop("label")
    scaled = ml.standard_scale(rows, VECTOR_COLUMNS, train=rows.filter("vec_id % 5 < 3"))
    return settle(scaled, *VECTOR_COLUMNS)


def scored_items(spark, sf):
    rows = measured_items(spark, sf)
    prediction, score = scoring.linear_score("features")
    label, _ = scoring.rule_score("features")
    return rows.withColumns({"prediction": prediction, "score": score, "label": label})


@register(
    f"WITH {SCORED} SELECT l_orderkey, l_linenumber, l_partkey, label, CASE label WHEN 0 THEN 0.9 ELSE 0.05 END::DOUBLE AS p0, "
    "CASE label WHEN 0 THEN 0.05 WHEN 1 THEN 0.85 ELSE 0.1 END::DOUBLE AS p1, "
    "CASE label WHEN 0 THEN 0.05 WHEN 1 THEN 0.1 ELSE 0.85 END::DOUBLE AS p2 FROM scored"
)
def rule_score(spark, sf):
    label, shares = scoring.rule_score("features")
    return (
        measured_items(spark, sf)
        .withColumns({"label": label, "shares": shares})
        .select("l_orderkey", "l_linenumber", "l_partkey", "label", *[F.col("shares")[i].alias(f"p{i}") for i in range(3)])
    )


@register(f"WITH {SCORED} SELECT l_orderkey, l_linenumber, l_partkey, prediction, score FROM scored")
def linear_score(spark, sf):
    return scored_items(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "prediction", "score")


_REPORT = f"""{SCORED}, classes AS (SELECT label AS cls FROM scored UNION SELECT prediction FROM scored),
  parts AS (SELECT cls AS label, count(*) FILTER (s.label = cls) AS support, count(*) FILTER (s.prediction = cls) AS said,
    count(*) FILTER (s.label = cls AND s.prediction = cls) AS hits FROM classes, scored s GROUP BY cls),
  rates AS (SELECT *, coalesce(hits / nullif(said, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall FROM parts),
  report AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM rates)"""


@register(f"WITH {_REPORT} SELECT label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM report")
def classification_report(spark, sf):
    return ml.classification_report(scored_items(spark, sf)).drop("hits")


_METRICS = f"""SELECT CAST(CAST(sum(hits) / sum(support) AS FLOAT) AS DOUBLE) AS accuracy, CAST(CAST(avg(f1) AS FLOAT) AS DOUBLE) AS f1_macro,
  CAST(CAST(sum(precision * support) / sum(support) AS FLOAT) AS DOUBLE) AS precision_weighted,
  CAST(CAST(sum(recall * support) / sum(support) AS FLOAT) AS DOUBLE) AS recall_weighted,
  CAST(CAST(sum(f1 * support) / sum(support) AS FLOAT) AS DOUBLE) AS f1_weighted FROM report"""
METRIC_NAMES = ("accuracy", "f1_macro", "precision_weighted", "recall_weighted", "f1_weighted")


@register(f"WITH {_REPORT} {_METRICS}")
def evaluate(spark, sf):
    return settle(ml.evaluate(scored_items(spark, sf)), *METRIC_NAMES)


@register(f"WITH {_REPORT} SELECT *, accuracy >= 0.82 AS passed, CAST(0.82 AS DOUBLE) AS threshold FROM ({_METRICS})")
def accuracy_gate(spark, sf):
    return settle(ml.accuracy_gate(ml.evaluate(scored_items(spark, sf))), *METRIC_NAMES)


@register(
    f"""WITH {SCORED}, classes AS (SELECT label AS cls FROM scored UNION SELECT prediction FROM scored)
    SELECT a.cls AS label, b.cls AS prediction, count(s.label) AS n FROM classes a CROSS JOIN classes b
    LEFT JOIN scored s ON s.label = a.cls AND s.prediction = b.cls GROUP BY 1, 2"""
)
def confusion_matrix(spark, sf):
    return ml.confusion_matrix(scored_items(spark, sf))


def _parts(spark, sf):
    return model_choice.split_parts(labelled_rides(spark, sf), "event_id", "label")


def _trained(spark, sf, name):
    """Whether the model does better on the test rows than saying the most frequent class."""
    parts = _parts(spark, sf)
    model = ml.train(parts["train"], RIDE_FEATURES, ml.CLASSIFIERS[name]())
    test = ml.merged_copies(parts["test"], RIDE_FEATURES)
    metrics = ml.evaluate(ml.batch_inference(model, test), copies=ml.COPIES)
    most = parts["test"].groupBy("label").count().agg((F.max("count") / F.sum("count")).alias("share")).scalar()
    return metrics.select(F.lit(name).alias("model"), (F.col("accuracy") > most).alias("beats_majority"))


def _beats(name):
    return f"SELECT '{name}' AS model, count(*) > 0 AS beats_majority FROM events"


@register(_beats("RandomForest"))
def train_random_forest(spark, sf):
    return _trained(spark, sf, "RandomForest")


@register(_beats("GradientBoosting"))
def train_gradient_boosting(spark, sf):
    return _trained(spark, sf, "GradientBoosting")


@register(_beats("SVM"))
def train_svm(spark, sf):
    return _trained(spark, sf, "SVM")


@register(_beats("LogisticRegression"))
def train_logistic(spark, sf):
    return _trained(spark, sf, "LogisticRegression")


_RESULTS = ("val_accuracy", "val_f1", "train_accuracy", "train_f1")


def _in_range(*columns):
    valid = F.lit(True)
    for c in columns:
        valid = valid & F.coalesce(F.col(c).between(0, 1), F.lit(False))
    return valid


@register(
    "SELECT 'trees=' || t || ',depth=' || d AS model, TRUE AS valid FROM (VALUES "
    + ", ".join(f"({t}, {d})" for t, d in ml.SWEEP)
    + ") v(t, d) WHERE (SELECT count(*) FROM events) > 0"
)
def param_sweep(spark, sf):
    return ml.param_sweep(_parts(spark, sf), RIDE_FEATURES).select("model", _in_range(*_RESULTS).alias("valid"))


@register(
    "SELECT model, TRUE AS valid, TRUE AS chosen_is_best, CAST(1 AS BIGINT) AS chosen, CAST(1 AS BIGINT) AS tested FROM (VALUES "
    "('RandomForest'), ('GradientBoosting'), ('SVM'), ('LogisticRegression')) v(model) WHERE (SELECT count(*) FROM events) > 0"
)
def model_selection(spark, sf):
    """All four classifiers; the one with the best F1 on the validation rows is judged on the test rows."""
    table_ = computed_once(model_choice.selection_table(labelled_rides(spark, sf), "event_id", RIDE_FEATURES))
    whole = table_.agg(
        F.max("val_f1").alias("best"), F.max(F.when(F.col("chosen"), F.col("val_f1"))).alias("own"),
        F.count_if("chosen").alias("chosen"), F.count_if(_in_range("test_accuracy", "test_f1_macro")).alias("tested"),
    )
    one = whole.select(F.struct((F.col("best") == F.col("own")).alias("is_best"), "chosen", "tested")).scalar()
    marked = table_.drop("chosen").withColumn("_w", one)
    return marked.select(
        "model", _in_range(*_RESULTS).alias("valid"), F.col("_w.is_best").alias("chosen_is_best"), "_w.chosen", "_w.tested"
    )


@register("SELECT CAST(4 AS BIGINT) AS models, CAST(0 AS BIGINT) AS better, TRUE AS chosen FROM events LIMIT 1")
def top_model(spark, sf):
    """The best of the fitted models by F1 on the validation rows: none is better, and it is the one chosen."""
    table_ = computed_once(model_choice.selection_table(labelled_rides(spark, sf), "event_id", RIDE_FEATURES))
    best = ml.top_model(table_).select(F.struct("model", "val_f1")).scalar()
    return table_.withColumn("_b", best).agg(
        F.count(F.lit(1)).alias("models"),
        F.count_if(F.col("val_f1") > F.col("_b.val_f1")).alias("better"),
        F.max(F.when(F.col("chosen"), F.col("model") == F.col("_b.model"))).alias("chosen"),
    )


@register(
    f"SELECT CAST({len(RIDE_FEATURES)} AS BIGINT) AS features, TRUE AS valid, CAST(1 AS DOUBLE) AS total FROM events LIMIT 1"
)
def feature_importance(spark, sf):
    """Importances of all features, none below zero, that sum to one."""
    model = ml.train(_parts(spark, sf)["train"], RIDE_FEATURES, ml.random_forest())
    found = ml.feature_importance(spark, model, RIDE_FEATURES)
    return found.agg(
        F.count(F.lit(1)).alias("features"), F.min(F.col("importance") >= 0).alias("valid"), F.round(F.sum("importance"), 9).alias("total")
    )


@register("SELECT event_id, TRUE AS is_most_likely, CAST(1 AS DOUBLE) AS total FROM events")
def batch_inference(spark, sf):
    """Every row has a prediction, which is its most likely class; probabilities sum to one."""
    rows = labelled_rides(spark, sf)
    model = ml.train(rows, RIDE_FEATURES, ml.logistic())
    scored = ml.batch_inference(model, rows, probabilities=True)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p)
    likely = F.get("probabilities", F.col("prediction").cast("int")) == F.array_max("probabilities")
    return scored.select("event_id", likely.alias("is_most_likely"), F.round(total, 9).alias("total"))


@register(
    "SELECT model, count(*) AS rows, CAST(3 AS BIGINT) AS classes, TRUE AS valid, TRUE AS better FROM events, "
    "(VALUES ('GradientBoosting'), ('SVM')) m(model) GROUP BY model"
)
def calibrated_probabilities(spark, sf):
    """Models of margins: probabilities of all rows sum to one, and on the test rows beat the plain sigmoid by log-loss."""
    parts, made = _parts(spark, sf), None
    test, rows = (ml.merged_copies(df, RIDE_FEATURES) for df in (parts["test"], labelled_rides(spark, sf)))
    for name in ("GradientBoosting", "SVM"):
        model = ml.train(parts["train"], RIDE_FEATURES, ml.CLASSIFIERS[name]())
        loss = ml.log_loss(ml.batch_inference(model, test, probabilities=True), copies=ml.COPIES)
        plain = ml.log_loss(ml.batch_inference(ml.uncalibrated(model), test, probabilities=True), copies=ml.COPIES)
        total = F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p)
        seen = ml.batch_inference(model, rows, probabilities=True).agg(
            F.sum(F.col(ml.COPIES).cast("bigint")).alias("rows"),
            F.max(F.size("probabilities")).cast("bigint").alias("classes"),
            F.min((F.abs(total - 1) < 1e-9) & (F.array_min("probabilities") >= 0)).alias("valid"),
        )
        seen = seen.select(F.lit(name).alias("model"), "*", (loss.scalar() < plain.scalar()).alias("better"))
        made = seen if made is None else made.unionByName(seen)
    return made


@register(
    "SELECT event_id, CAST(count(*) AS BIGINT) AS classes, TRUE AS valid, CAST(1 AS DOUBLE) AS total FROM events, "
    "(VALUES (0), (1), (2)) v(class) GROUP BY event_id"
)
def predict_proba(spark, sf):
    rows = labelled_rides(spark, sf)
    model = ml.train(rows, RIDE_FEATURES, ml.random_forest())
    scored = ml.batch_inference(model, rows, probabilities=True)
    each = scored.select("event_id", F.posexplode("probabilities").alias("class", "probability"))
    return each.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("classes"),
        F.min(F.col("probability").between(0, 1)).alias("valid"),
        F.round(F.sum("probability"), 9).alias("total"),
    )


@register("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS changed FROM events")
def save_load_model(spark, sf):
    """Predictions of a saved and reloaded model next to those of the original."""
    rows = labelled_rides(spark, sf)
    model = ml.train(rows, RIDE_FEATURES, ml.logistic())
    loaded = ml.load_model(ml.save_model(model, scratch_path(spark, "model")))
    first = ml.batch_inference(model, rows).select("event_id", F.col("prediction").alias("before"))
    second = ml.batch_inference(loaded, rows).select("event_id", "prediction")
    both = first.join(second, "event_id", "full")
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("before").eqNullSafe(F.col("prediction"))).alias("changed")
    )
