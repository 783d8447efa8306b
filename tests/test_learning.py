from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from conftest import rows_of
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ridelake.functions import scoring
from ridelake.operators import learning as ml
from ridelake.operators import margins
from ridelake.plans import model_choice


def flowers(spark, n=300):
    """Three classes that two of four measures tell apart."""
    cls = (F.col("id") % 3).cast("int")
    noise = [F.rand(i) for i in range(4)]
    return spark.range(n).select(
        "id", noise[0].alias("a"), noise[1].alias("b"), (cls * 2 + noise[2]).alias("c"), (cls + noise[3] / 2).alias("d"), cls.alias("label")
    )


COLUMNS = ["a", "b", "c", "d"]


@pytest.mark.parametrize(
    "features, cls, shares",
    [
        ([4.7, 3.3, 1.1, 0.4], 0, [0.9, 0.05, 0.05]),
        ([6.0, 2.9, 4.5, 1.5], 1, [0.05, 0.85, 0.1]),
        ([6.5, 3.0, 5.2, 2.0], 2, [0.05, 0.1, 0.85]),
        ([0.0, 0.0, 2.5, 0.0], 1, [0.05, 0.85, 0.1]),
        ([0.0, 0.0, 5.0, 0.0], 2, [0.05, 0.1, 0.85]),
        ([1.0, 2.0, 3.0], None, None),
    ],
)
def test_rule_score(spark, features, cls, shares):
    df = spark.createDataFrame([(features,)], "f array<double>")
    label, probabilities = scoring.rule_score("f")
    row = df.select(label.alias("l"), probabilities.alias("p"), scoring.feature_error("f").alias("e")).first()
    assert (row.l, row.p, row.e is not None) == (cls, shares, cls is None)


def test_linear_score_is_clamped(spark):
    df = spark.createDataFrame([([5.0, 2.8, 4.0, 1.3],), ([99.0] * 4,), ([-9.0] * 4,), ([1.0],)], "f array<double>")
    label, score = scoring.linear_score("f")
    got = [tuple(r) for r in df.select(label, score).collect()]
    assert got[0][0] == 0 and math.isclose(got[0][1], 0.3395)
    assert got[1:] == [(2, 1.0), (0, 0.0), (None, None)]


def test_prediction_results(spark):
    df = spark.createDataFrame([(0.91,), (0.85,), (0.8499,), (None,)], "s double")
    assert [r[0] for r in df.select(scoring.anomaly_result("s")).collect()] == ["anomaly", "anomaly", "normal", "normal"]


def test_splits_have_exact_shares_and_are_reproducible(spark):
    df = flowers(spark, 500)
    parts = ml.split_random(df, "id")
    assert Counter(r.split for r in parts.collect()) == {"train": 400, "test": 100}
    assert rows_of(parts, "id", "split") == rows_of(ml.split_random(df.repartition(7), "id"), "id", "split")
    assert rows_of(parts, "id", "split") != rows_of(ml.split_random(df, "id", seed=1), "id", "split")
    uneven = df.withColumn("label", F.when(F.col("id") < 350, 0).when(F.col("id") < 490, 1).otherwise(2))
    counts = Counter((r.label, r.split) for r in ml.split_stratified(uneven, "id", "label").collect())
    assert [counts[c, s] for c in (0, 1, 2) for s in ("train", "validation", "test")] == [210, 70, 70, 84, 28, 28, 6, 2, 2]


def test_scaling_uses_train_statistics(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (9.0, 5.0)], "a double, b double")
    scaled = ml.standard_scale(df, ["a", "b"], train=df.filter("a < 5"))
    assert rows_of(scaled) == [(-1.0, 0.0), (1.0, 0.0), (7.0, 0.0)]


def test_metrics_by_hand(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(2, 0)]
    scored = spark.createDataFrame(pairs, "label int, prediction int")
    report = {r.label: r for r in ml.classification_report(scored).collect()}
    assert (report[0].precision, report[0].recall, report[0].support) == (0.75, 0.75, 4)
    assert (report[2].precision, report[2].recall, report[2].f1, report[2].support) == (0.0, 0.0, 0.0, 1)
    metrics = ml.evaluate(scored).first()
    assert math.isclose(metrics.accuracy, 5 / 7) and math.isclose(metrics.f1_macro, (0.75 + 0.8 + 0.0) / 3)
    assert len(rows_of(ml.confusion_matrix(scored))) == 9
    assert rows_of(ml.confusion_matrix(scored).filter("n > 0")) == [(0, 0, 3), (0, 1, 1), (1, 1, 2), (2, 0, 1)]


def test_gate_and_best_model(spark):
    metrics = spark.createDataFrame([("b", 0.82), ("a", 0.82), ("c", 0.81), ("d", None)], "model string, accuracy double")
    assert [r.passed for r in ml.accuracy_gate(metrics).collect()] == [True, True, False, None]
    assert ml.top_model(metrics, by="accuracy").first()["model"] == "a"


def test_models_learn_and_survive_saving(spark, folder):
    df = flowers(spark).checkpoint()
    results, name, model, test, report = model_choice.choose_model(
        df, "id", COLUMNS, classifiers={k: ml.CLASSIFIERS[k] for k in ("RandomForest", "LogisticRegression")}
    )
    assert results.columns == ["model", "val_accuracy", "val_f1", "train_accuracy", "train_f1"]
    assert name in ("RandomForest", "LogisticRegression") and test.first()["accuracy"] >= 0.85
    assert report.count() == 3
    scored = ml.batch_inference(model, df, probabilities=True)
    assert all(math.isclose(sum(r.probabilities), 1.0, rel_tol=1e-9) for r in scored.limit(20).collect())
    loaded = ml.load_model(ml.save_model(model, folder))
    assert rows_of(ml.batch_inference(loaded, df), "id", "prediction") == rows_of(scored, "id", "prediction")


def test_forest_importance_and_missing_probabilities(spark):
    df = flowers(spark).checkpoint()
    forest = ml.train(df, COLUMNS, ml.random_forest(trees=20, depth=3))
    ranked = [r.feature for r in ml.feature_importance(spark, forest, COLUMNS).orderBy(F.desc("importance")).collect()]
    assert set(ranked[:2]) == {"c", "d"}
    boosted = ml.train(df, COLUMNS, ml.gradient_boosting(rounds=2, depth=2))
    assert ml.evaluate(ml.batch_inference(boosted, df)).first()["accuracy"] > 0.8
    bare = PipelineModel(ml.train(df, COLUMNS, ml.support_vectors(5, kernel="linear")).stages[:-1])
    with pytest.raises(AttributeError):
        ml.batch_inference(bare, df, probabilities=True)


def rings(spark, n=1500):
    """Two classes that no line parts: a disc and a ring around it."""
    angle, radius = F.rand(1) * 6.283185307179586, F.when(F.col("id") % 2 == 0, F.rand(2)).otherwise(1.6 + F.rand(3))
    return spark.range(n).select("id", (radius * F.cos(angle)).alias("x"), (radius * F.sin(angle)).alias("y"), (F.col("id") % 2).cast("int").alias("label"))


def test_radial_kernel_parts_rings(spark, folder):
    df = rings(spark).checkpoint()
    train, test = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    accuracy = {}
    for kernel in ("linear", "rbf"):
        model = ml.train(train, ["x", "y"], ml.support_vectors(kernel=kernel))
        accuracy[kernel] = ml.evaluate(ml.batch_inference(model, test)).first()["accuracy"]
    assert accuracy["rbf"] > 0.95 and accuracy["linear"] < 0.75
    loaded = ml.load_model(ml.save_model(model, folder))
    scored = [rows_of(ml.batch_inference(m, test, probabilities=True), "id", "prediction", "probabilities") for m in (model, loaded)]
    assert scored[0] == scored[1]
    with pytest.raises(ValueError):
        ml.support_vectors(kernel="cubic")


def test_random_features_come_near_the_kernel(spark):
    points = [[0.0, 0.0], [0.5, -0.5], [1.0, 2.0], [-1.0, 0.3]]
    df = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in enumerate(points)], StructType([StructField("i", IntegerType()), StructField("v", VectorUDT())]))
    made = margins.RandomFourierFeatures("v", "z", inputs=2, size=4000, gamma=0.5).transform(df).orderBy("i").collect()
    z = np.array([r.z.toArray() for r in made])
    exact = np.exp(-0.5 * ((np.array(points)[:, None] - np.array(points)[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.08


@pytest.mark.parametrize("name", ["GradientBoosting", "SVM", "RandomForest", "LogisticRegression"])
def test_probabilities_of_all_models(spark, name):
    df = flowers(spark, 900).withColumn("label", F.when(F.rand(9) < 0.2, (F.rand(8) * 3).cast("int")).otherwise(F.col("label"))).checkpoint()
    train, test = df.filter("id % 5 > 0"), df.filter("id % 5 = 0")
    model = ml.train(train, COLUMNS, ml.gradient_boosting(rounds=10) if name == "GradientBoosting" else ml.CLASSIFIERS[name]())
    scored = ml.batch_inference(model, test, probabilities=True)
    rows = scored.collect()
    assert all(len(r.probabilities) == 3 and math.isclose(sum(r.probabilities), 1, rel_tol=1e-9) for r in rows)
    assert all(r.probabilities[r.prediction] == max(r.probabilities) for r in rows)
    if name in ("GradientBoosting", "SVM"):
        plain = ml.batch_inference(ml.uncalibrated(model), test, probabilities=True)
        assert ml.log_loss(scored).first()[0] < ml.log_loss(plain).first()[0]


@pytest.mark.parametrize("name", ["SVM", "LogisticRegression"])
def test_models_of_two_classes_score_in_a_session_that_has_observed(spark, name):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    df = flowers(spark, 300).filter("label < 2").checkpoint()
    classifier = ml.support_vectors(5, kernel="linear") if name == "SVM" else ml.logistic(20)
    assert ml.evaluate(ml.batch_inference(ml.train(df, COLUMNS, classifier), df)).first()["accuracy"] > 0.9


def test_sigmoid_of_margins(spark):
    drawn = spark.range(20_000).select((F.randn(1) * 2).alias("margin"), F.rand(2).alias("u"))
    rows = drawn.select("margin", (F.col("u") < 1 / (1 + F.exp(-(F.col("margin") * 1.5 - 0.7)))).cast("double").alias("_own"))
    slope, intercept = margins.sigmoid(rows)
    assert abs(slope - 1.5) < 0.1 and abs(intercept + 0.7) < 0.1
    assert margins.sigmoid(rows.filter("_own = 1")) == (1.0, 0.0)


def test_equal_rows_are_fitted_and_judged_once(spark):
    few = flowers(spark, 90)
    many = few.withColumn("copy", F.explode(F.sequence(F.lit(1), 20 + F.col("label") * 20))).checkpoint()
    merged = ml.merged_copies(many, COLUMNS)
    assert merged.count() == 90 and merged.agg(F.sum(ml.COPIES)).first()[0] == 30 * (20 + 40 + 60)
    assert 90 < ml.merged_copies(many, COLUMNS, apart=4).count() <= 360
    for classifier in (ml.logistic(50), ml.gradient_boosting(rounds=3, depth=2), ml.support_vectors(20)):
        model = ml.train(many, COLUMNS, classifier)
        whole, once = ml.batch_inference(model, many, probabilities=True), ml.batch_inference(model, merged, probabilities=True)
        assert rows_of(ml.classification_report(whole)) == rows_of(ml.classification_report(once, copies=ml.COPIES))
        assert math.isclose(ml.log_loss(whole).first()[0], ml.log_loss(once, copies=ml.COPIES).first()[0], rel_tol=1e-9)
    ours = ml.train(many, COLUMNS, ml.logistic(50)).stages[-1]
    theirs = ml.logistic(50).fit(PipelineModel(ml.train(many, COLUMNS, ml.logistic(50)).stages[:-1]).transform(many))
    assert np.allclose(ours.interceptVector.toArray(), theirs.interceptVector.toArray(), rtol=0.05, atol=0.2)


def test_trees_are_fitted_on_bins(spark, monkeypatch):
    """Rows that trees cannot tell apart are one: many different values make no more rows to fit, and the same trees."""
    df = spark.range(20_000).select("id", F.rand(1).alias("a"), (F.col("id") % 7).cast("double").alias("c")).checkpoint()
    df = df.withColumn("label", (F.col("a") > 0.6).cast("int") + (F.col("a") > 0.9).cast("int"))
    seen, merge = [], ml.merged_copies
    monkeypatch.setattr(ml, "merged_copies", lambda *a: seen.append(merge(*a)) or seen[-1])
    for classifier, parts in ((ml.gradient_boosting(rounds=3, depth=3), 2), (ml.random_forest(trees=5, depth=5), ml.DRAWN_APART)):
        model = ml.train(df, ["a", "c"], classifier)
        assert ml.evaluate(ml.batch_inference(model, df)).first()["accuracy"] > 0.95
        # A bin may hold two labels, and rows kept for calibration beside others.
        assert seen[-1].count() <= (32 + 2) * 7 * parts and seen[-1].agg(F.sum(ml.COPIES)).first()[0] == 20_000


def test_bins_are_cut_between_values(spark):
    df = spark.range(1000).select((F.col("id") % 4).cast("double").alias("few"), F.col("id").cast("double").alias("many"), F.lit(1.0).alias("one"))
    df = df.unionByName(spark.createDataFrame([(float("nan"), float("nan"), 1.0)], df.schema))
    cuts = ml.bin_cuts(df, ["few", "many", "one"], 8)
    assert cuts["few"] == [0.5, 1.5, 2.5] and cuts["one"] == []
    assert len(cuts["many"]) == 7 and all(abs(c - 125 * (i + 1)) <= 2 and c % 1 == 0.5 for i, c in enumerate(cuts["many"]))


def test_lines_of_all_classes_share_their_passes(spark):
    """Slopes that LinearSVC finds for each class by itself; kernel features are made in each pass and kept nowhere."""
    df = flowers(spark, 600).withColumn("label", F.when(F.rand(9) < 0.1, (F.rand(8) * 3).cast("int")).otherwise(F.col("label"))).checkpoint()
    rows = df.select(F.array(*COLUMNS).alias("inputs"), "label", (F.lit(1.0) + F.col("id") % 3).alias("weight"))
    ours = margins.fit_lines(rows, 3, 4, None, maxIter=200, regParam=0.01, tol=1e-7)
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.functions import array_to_vector

    for k, (slopes, shift) in enumerate(ours):
        own = rows.select(array_to_vector("inputs").alias("features"), (F.col("label") == k).cast("double").alias("label"), "weight")
        theirs = LinearSVC(maxIter=200, regParam=0.01, tol=1e-7, weightCol="weight").fit(own)
        at = np.array([r.inputs for r in rows.collect()])
        side, w = np.array([1.0 if r.label == k else -1.0 for r in rows.collect()]), np.array([r.weight for r in rows.collect()])
        lost = [
            np.average(np.maximum(0, 1 - side * (at @ c + b)), weights=w) + 0.005 * ((c * at.std(0)) ** 2).sum()
            for c, b in ((slopes, shift), (theirs.coefficients.toArray(), theirs.intercept))
        ]
        assert lost[0] <= lost[1] * 1.01
