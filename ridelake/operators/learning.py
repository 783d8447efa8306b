"""Labels, splits, scaling, training, evaluation and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.margins import CalibratedMargins, OneAgainstRest, without_summary
from ridelake.operators.ordered import running_rank
from ridelake.operators.profiling import column_map, per_column
from ridelake.operators.quantiles import numeric
from ridelake.operators.sizing import broadcast_if_small, computed_once

SEED = 42

# How often a row of ``merged_copies`` occurs.
COPIES = "_copies"

# Fits pass over merged rows hundreds of times: fewer of them than this are no task of their own.
ROWS_PER_TASK = 50_000

# A forest draws rows, not copies: equal rows are dealt over as many rows as this, which are drawn each by itself. Trees
# take rows for equal that lie in the same bins.
DRAWN_APART = 16

# Fixed value: accuracy from which a model passes.
MIN_ACCURACY = 0.82

# Trees and depth of each run of the parameter sweep.
SWEEP = ((50, 3), (100, 5), (200, 10))


def label_encode(df: DataFrame, column: str, output: str = "label") -> DataFrame:
    """Index of each class in alphabetical order."""
    indexer = StringIndexer(inputCol=column, outputCol=output, stringOrderType="alphabetAsc")
    return indexer.fit(df).transform(df)


def _draw(key: str, seed: int) -> Column:
    """A seeded hash of the row's id, as hex text: a reproducible random order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def _ranked(df: DataFrame, key: str, classes: Sequence[str], seed: int) -> DataFrame:
    """Add the row's place in the random order of its class, and the size of the class.

    The leading four hex digits chunk the order into 65,536 even parts, so no class is ever
    ordered in one task.
    """
    drawn = df.withColumn("_draw", _draw(key, seed))
    ranked = running_rank(drawn, classes, ["_draw", key], F.substring("_draw", 1, 4), "_place")
    if not classes:
        return ranked.withColumn("_size", df.agg(F.count(F.lit(1))).scalar())
    sizes = df.groupBy(*classes).agg(F.count(F.lit(1)).alias("_size"))
    return ranked.join(broadcast_if_small(sizes), list(classes))


def _cut(ranked: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """Name the part each place falls into; the last part takes what rounding leaves over."""
    names, reached, chosen = list(shares), 0.0, None
    for name in names[:-1]:
        reached += shares[name]
        inside = F.col("_place") <= F.floor(F.round(F.col("_size") * F.lit(reached), 6))
        chosen = F.when(inside, F.lit(name)) if chosen is None else chosen.when(inside, F.lit(name))
    return ranked.withColumn("split", chosen.otherwise(F.lit(names[-1]))).drop("_draw", "_place", "_size")


def split_random(
    df: DataFrame, key: str, shares: Mapping[str, float] | None = None, seed: int = SEED
) -> DataFrame:
    """Add ``split`` with exact shares (80 % train, 20 % test), by a seeded order of the ids."""
    return _cut(_ranked(df, key, [], seed), shares or {"train": 0.8, "test": 0.2})


def split_stratified(
    df: DataFrame, key: str, label: str, shares: Mapping[str, float] | None = None, seed: int = SEED
) -> DataFrame:
    """Add ``split`` with the same shares (60/20/20) in each class. Labels must not be null."""
    return _cut(
        _ranked(df, key, [label], seed), shares or {"train": 0.6, "validation": 0.2, "test": 0.2}
    )


def scale_statistics(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column; a constant column is scaled by 1."""
    spread = per_column(
        train, columns, {"mean": lambda c: F.avg(numeric(c)), "std": lambda c: F.stddev_pop(numeric(c))}
    )
    return spread.withColumn("std", F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")))


def standard_scale(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Columns centred and scaled by the statistics of ``train`` (of ``df`` if not given)."""
    fitted = column_map(scale_statistics(df if train is None else train, columns), F.struct("mean", "std"))
    scaled = {
        c: (numeric(c) - F.col("_fit")[c]["mean"]) / F.col("_fit")[c]["std"] for c in columns
    }
    return df.withColumn("_fit", fitted).withColumns(scaled).drop("_fit")


def random_forest(trees: int = 100, depth: int = 5, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)


def gradient_boosting(rounds: int = 100, depth: int = 3, seed: int = SEED) -> OneAgainstRest:
    """Boosted trees are binary in Spark ML: one class against the rest, their margins calibrated."""
    return OneAgainstRest(GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed))


def support_vectors(iterations: int = 100, penalty: float = 0.01, kernel: str = "rbf") -> OneAgainstRest:
    """Support vectors on random features of a radial kernel, or with ``linear`` on the scaled columns themselves.

    The penalty keeps the objective strictly convex: without one the search may not settle.
    """
    if kernel not in ("rbf", "linear"):
        raise ValueError(f"no kernel {kernel}")
    return OneAgainstRest(LinearSVC(maxIter=iterations, regParam=penalty), radial=kernel == "rbf")


def logistic(iterations: int = 1000) -> LogisticRegression:
    return LogisticRegression(maxIter=iterations)


CLASSIFIERS = {
    "RandomForest": random_forest,
    "GradientBoosting": gradient_boosting,
    "SVM": support_vectors,
    "LogisticRegression": logistic,
}


def merged_copies(df: DataFrame, columns: Sequence[str], label: str = "label", apart: int = 1) -> DataFrame:
    """``columns`` and label of rows that differ in them, with the number of such rows in ``COPIES``.

    With ``apart`` equal rows are first dealt over so many groups by a hash of all their columns. The order of the rows
    within a partition is fixed, as draws of rows follow it. The result is computed once.
    """
    keys = [*columns, label]
    rows = df if apart == 1 else df.withColumn("_dealt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(apart)))
    keys += ["_dealt"] * (apart > 1)
    merged = computed_once(rows.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(COPIES)))
    tasks = -(-merged.count() // ROWS_PER_TASK)
    return merged.coalesce(max(1, tasks)).sortWithinPartitions(*keys).drop("_dealt")


def bin_cuts(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Where each column is cut into at most ``bins`` bins: halfway between neighbours among all its values, if these are no
    more, else after each of its quantiles. All rows count."""
    cuts, wide = {}, []
    for c in columns:
        few = [r[0] for r in df.select(c).distinct().limit(bins + 1).collect()]
        # Nulls are no values; NaN is above all and has no neighbour halfway.
        values = sorted(v for v in few if v is not None and v == v)
        if len(few) > bins:
            wide.append(c)
        else:
            cuts[c] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    if wide:
        at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
        found = df.agg(*[F.percentile_approx(F.nanvl(c, F.lit(None)), at, 10_000).alias(c) for c in wide]).first()
        reached = {c: sorted(set(found[c] or ())) for c in wide}
        above = [F.min(F.when((F.col(c) > q) & ~F.isnan(c), F.col(c))).alias(f"{c}_{i}") for c in wide for i, q in enumerate(reached[c])]
        after = df.agg(*above).first() if above else {}
        for c in wide:
            pairs = [(q, after[f"{c}_{i}"]) for i, q in enumerate(reached[c])]
            cuts[c] = [(q + n) / 2 for q, n in pairs if n is not None]
    return {c: cuts[c] for c in columns}


def train(df: DataFrame, columns: Sequence[str], classifier, label: str = "label") -> PipelineModel:
    """Scale, assemble, fit: a Spark ML estimator or ``OneAgainstRest``. The result scores raw columns.

    Rows equal in columns and label are fitted as one row with their number as its weight, which has the same loss.
    Trees see of a column only its bin: they are fitted on the numbers of the bins, and rows of the same bins are one.
    The scale, one mean and population deviation per column, is kept as SQL in the pipeline, as are the bins:
    ``StandardScaler`` would divide by the sample deviation.
    """
    scale = {row["column_name"]: (row["mean"], row["std"]) for row in scale_statistics(df, columns).collect()}
    scaled = ", ".join(
        f"(CAST({c} AS DOUBLE) - ({scale[c][0]!r}D)) / ({scale[c][1]!r}D) AS scaled_{c}" for c in columns
    )
    several = isinstance(classifier, OneAgainstRest)
    one = classifier.binary if several else classifier
    kernel = classifier.kernel(len(columns), "scaled") if several else []
    weight = COPIES if one.hasParam("weightCol") else None
    drawn = DRAWN_APART if one.hasParam("bootstrap") else 1
    scaling = SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")
    kept = ["features", label] + [COPIES] * (weight is not None)
    if weight and one.hasParam("maxBins"):
        rows = scaling.transform(df)
        cuts = bin_cuts(rows, [f"scaled_{c}" for c in columns], one.getOrDefault("maxBins"))
        found = [" + ".join([f"CAST({c} > {cut!r}D AS DOUBLE)" for cut in cuts[c]] or [f"{c} * 0"]) for c in cuts]
        names = [f"bin_{c}" for c in columns]
        binning = SQLTransformer(statement=f"SELECT *, {', '.join(f'{b} AS {n}' for b, n in zip(found, names))} FROM __THIS__")
        prepare = [scaling, binning, VectorAssembler(inputCols=names, outputCol="features")]
        rows = binning.transform(rows)
        if several:
            # Rows kept for calibration are chosen by themselves, not by their bins.
            rows = rows.withColumn("_apart", classifier.is_apart(F.array(*cuts)))
        cells = [*names, *["_apart"] * several]
        vectors = prepare[-1].transform(merged_copies(rows, cells, label, drawn)).select(*kept, *cells[len(names) :])
    else:
        prepare = [scaling, VectorAssembler(inputCols=[f"scaled_{c}" for c in columns], outputCol="scaled" if kernel else "features"), *kernel]
        rows = merged_copies(df, columns, label, drawn) if weight else df
        # Kernel features are made again in each pass; what is kept is their input.
        vectors = PipelineModel(prepare[:2]).transform(rows).select("scaled" if kernel else "features", *kept[1:])
    # Fitting passes over the rows many times: they are kept, not derived anew each time.
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if several:
            fitted = classifier.fit(vectors, label, weight)
        else:
            made = classifier.copy().setLabelCol(label)
            made = made if weight is None else made.setWeightCol(weight)
            fitted = [without_summary(made.fit(vectors), df.sparkSession)]
    finally:
        vectors.unpersist()
    return PipelineModel([*prepare, *fitted])


def has_probabilities(model: PipelineModel) -> bool:
    return bool(getattr(model.stages[-1], "hasParam", lambda _: False)("probabilityCol"))


def _scored(model: Transformer, df: DataFrame) -> DataFrame:
    """``model.transform``, but one-against-rest models are compared in the JVM.

    Their own transform collects the margins of the classes row by row in Python.
    """
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if not isinstance(last, OneVsRestModel):
        return model.transform(df)
    rows, margins = PipelineModel(model.stages[:-1]).transform(df), []
    for i, one in enumerate(last.models):
        made = one.copy().setRawPredictionCol("_raw_margin").setPredictionCol("_one").transform(rows)
        margins.append(f"_margin_{i}")
        kept = vector_to_array("_raw_margin")[1].alias(margins[-1])
        rows = made.select(*rows.columns, kept)
    widest = F.array(*margins)
    return rows.withColumn("prediction", F.array_position(widest, F.array_max(widest)) - 1).drop(*margins)


def batch_inference(model: Transformer, df: DataFrame, probabilities: bool = False) -> DataFrame:
    """Add ``prediction`` and, if asked for, the ``probabilities`` of the classes as an array.

    Asking a model that has none for probabilities raises.
    """
    if probabilities and not has_probabilities(model):
        raise AttributeError("the model gives no class probabilities")
    scored = _scored(model, df)
    made = [F.col("prediction").cast("int").alias("prediction")]
    if probabilities:
        made.append(vector_to_array("probability").alias("probabilities"))
    return scored.select(*df.columns, *made)


def log_loss(scored: DataFrame, label: str = "label", copies: str | None = None) -> DataFrame:
    """One row: mean negative logarithm of the probability given to the row's own class.

    Here and in the metrics below, ``copies`` names a column that says for how many rows a row stands.
    """
    own = F.get("probabilities", F.col(label).cast("int"))
    loss = -F.log(F.greatest(F.coalesce(own, F.lit(0.0)), F.lit(1e-15)))
    mean = F.avg(loss) if copies is None else F.try_divide(F.sum(loss * F.col(copies)), F.sum(copies))
    return scored.agg(mean.alias("log_loss"))


def uncalibrated(model: PipelineModel) -> PipelineModel:
    """The same model with plain sigmoids of its margins, to compare with."""
    *stages, last = model.stages
    if not isinstance(last, CalibratedMargins):
        raise TypeError("the model has no calibrated margins")
    n = len(last.getOrDefault(last.slopes))
    return PipelineModel([*stages, CalibratedMargins([1.0] * n, [0.0] * n)])


def confusion_counts(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", copies: str | None = None
) -> DataFrame:
    """Rows per (label, prediction) that occurs."""
    n = F.count(F.lit(1)) if copies is None else F.sum(F.col(copies).cast("bigint"))
    return scored.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        n.alias("n")
    )


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction), zero where a pair of known classes does not occur.

    Works on counts: the grid is the square of the number of classes.
    """
    counts = confusion_counts(scored, label, prediction)
    classes = F.array_distinct(F.flatten(F.collect_set(F.array("label", "prediction"))))
    grid = (
        counts.agg(F.array_compact(classes).alias("classes"))
        .select("classes", F.explode("classes").alias("label"))
        .select("label", F.explode("classes").alias("prediction"))
    )
    return grid.join(counts, ["label", "prediction"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def classification_report(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", copies: str | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a divisor is 0."""
    counts = confusion_counts(scored, label, prediction, copies)
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("cls"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("said")),
                F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("said")),
            )
        ),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
    )
    # Every counted pair appears twice, once per side; hits are taken from the label side.
    per_class = sides.groupBy("cls").agg(
        F.sum("actual").alias("support"),
        F.sum("said").alias("said"),
        F.sum(F.when(F.col("actual") > 0, F.col("hit")).otherwise(0)).alias("hits"),
    )
    ratios = per_class.withColumns(
        {
            "precision": F.coalesce(F.try_divide("hits", "said"), F.lit(0.0)),
            "recall": F.coalesce(F.try_divide("hits", "support"), F.lit(0.0)),
        }
    )
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return ratios.select(
        F.col("cls").alias("label"), "precision", "recall", F.coalesce(f1, F.lit(0.0)).alias("f1"), "support", "hits"
    )


def evaluate(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", copies: str | None = None
) -> DataFrame:
    """One row: accuracy, macro F1, and precision, recall and F1 weighted by support."""
    weight = F.col("support")
    total = F.sum(weight)

    def weighted(name: str) -> Column:
        return F.try_divide(F.sum(F.col(name) * weight), total).alias(f"{name}_weighted")

    return classification_report(scored, label, prediction, copies).agg(
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        weighted("precision"),
        weighted("recall"),
        weighted("f1"),
    )


def accuracy_gate(metrics: DataFrame, minimum: float = MIN_ACCURACY) -> DataFrame:
    """Add whether the accuracy reaches the minimum."""
    return metrics.withColumns({"passed": F.col("accuracy") >= minimum, "threshold": F.lit(minimum)})


def top_model(results: DataFrame, by: str = "val_f1") -> DataFrame:
    """The best row; of equally good ones the first by name."""
    return results.orderBy(F.desc_nulls_last(by), "model").limit(1)


def model_results(
    parts: Mapping[str, DataFrame], columns: Sequence[str], classifiers: Mapping | None = None, label: str = "label"
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit each classifier on ``train``; a row of train and validation metrics for each."""
    models, rows = {}, None
    # All models score these, equal rows once.
    seen = {part: merged_copies(parts[part], columns, label) for part in ("validation", "train")}
    for name, make in (classifiers or CLASSIFIERS).items():
        models[name] = train(parts["train"], columns, make(), label)
        row = None
        for part, prefix in (("validation", "val"), ("train", "train")):
            metrics = evaluate(batch_inference(models[name], seen[part]), label, copies=COPIES).select(
                F.col("accuracy").alias(f"{prefix}_accuracy"), F.col("f1_macro").alias(f"{prefix}_f1")
            )
            as_row = metrics.select(F.struct("*").alias(prefix))
            row = (
                as_row.withColumn("model", F.lit(name))
                if row is None
                else row.withColumn(prefix, as_row.scalar())
            )
        row = row.select("model", "val.*", "train.*")
        rows = row if rows is None else rows.unionByName(row)
    return rows, models


def param_sweep(
    parts: Mapping[str, DataFrame], columns: Sequence[str], sweep: Sequence[tuple[int, int]] = SWEEP, label: str = "label"
) -> DataFrame:
    """Train and validation metrics of a random forest for each (trees, depth)."""
    runs = {f"trees={t},depth={d}": (lambda t=t, d=d: random_forest(t, d)) for t, d in sweep}
    return model_results(parts, columns, runs, label)[0]


def feature_importance(spark: SparkSession, model: PipelineModel, columns: Sequence[str]) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(c, float(v)) for c, v in zip(columns, values)], "feature string, importance double"
    )


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
