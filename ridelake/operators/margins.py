"""Classifiers that part two classes, made to part several and to give probabilities; a radial kernel by random features.

Everything a fitted pipeline needs is in its stages: it is saved and loaded like any other. It scores in JVM expressions, but for
the random features, which are made batch by batch.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Callable, Generator, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.session import scratch_path


def without_summary(model: Transformer, spark: SparkSession) -> Transformer:
    """A fitted model as it is after saving and loading.

    The summary of a fit of two classes holds the session, which goes with the model into every task that scores. Once the
    session has observed anything it cannot be sent, and scoring fails.
    """
    if not getattr(model, "hasSummary", False):
        return model
    path = scratch_path(spark, "model")
    model.write().save(path)
    return type(model).load(path)


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Features whose inner products are near ``exp(-gamma * |x - y|^2)``: cosines of random projections.

    ``gamma`` is by default one over the number of inputs, which suits inputs of unit variance. The projections follow
    from the seed, so nothing but the parameters is saved.
    """

    size = Param(Params._dummy(), "size", "number of random features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel; 0 for one over the number of inputs", TypeConverters.toFloat)
    inputs = Param(Params._dummy(), "inputs", "number of inputs", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "of the projections", TypeConverters.toInt)

    def __init__(self, inputCol: str = "features", outputCol: str = "features", inputs: int = 1, size: int = 128, gamma: float = 0.0, seed: int = 42) -> None:
        super().__init__()
        self._setDefault(inputCol="features", outputCol="features", inputs=1, size=128, gamma=0.0, seed=42)
        self._set(inputCol=inputCol, outputCol=outputCol, inputs=inputs, size=size, gamma=gamma, seed=seed)

    def projections(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights, a row for each feature, and shifts."""
        inputs, size = self.getOrDefault(self.inputs), self.getOrDefault(self.size)
        random = np.random.default_rng(self.getOrDefault(self.seed))
        width = np.sqrt(2 * (self.getOrDefault(self.gamma) or 1 / inputs))
        return random.normal(size=(size, inputs)) * width, random.uniform(0, 2 * np.pi, size)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, shifts = self.projections()
        scale = float(np.sqrt(2 / len(shifts)))

        # A batch at once: as SQL on arrays a row takes many times longer.
        def features(inputs: pa.Array) -> pa.Array:
            rows = inputs.flatten().to_numpy(zero_copy_only=False).reshape(len(inputs), weights.shape[1])
            made = np.cos(rows @ weights.T + shifts) * scale
            return pa.ListArray.from_arrays(np.arange(len(inputs) + 1, dtype=np.int32) * len(shifts), made.ravel())

        made = F.arrow_udf(features, "array<double>")(vector_to_array(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(made))


class CalibratedMargins(Transformer, HasPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """Probabilities from the margins of one-against-rest models: a sigmoid for each class, normalised over the classes.

    The prediction is the class of the greatest probability. The models' own columns are dropped.
    """

    slopes = Param(Params._dummy(), "slopes", "of the sigmoids", TypeConverters.toListFloat)
    intercepts = Param(Params._dummy(), "intercepts", "of the sigmoids", TypeConverters.toListFloat)

    def __init__(self, slopes: Sequence[float] = (), intercepts: Sequence[float] = ()) -> None:
        super().__init__()
        self._setDefault(predictionCol="prediction", probabilityCol="probability", slopes=[], intercepts=[])
        self._set(slopes=list(slopes), intercepts=list(intercepts))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        both = list(zip(self.getOrDefault(self.slopes), self.getOrDefault(self.intercepts)))
        raised = [F.lit(1.0) / (F.exp(-(_margin(k) * a + b)) + 1.0) for k, (a, b) in enumerate(both)]
        made = dataset.withColumn("_each", F.array(*raised))
        total = reduce(add, [F.col("_each")[k] for k in range(len(both))])
        shares = F.transform("_each", lambda p: F.when(total > 0, p / total).otherwise(1.0 / len(both)))
        made = made.withColumn("_each", shares)
        made = made.withColumn(self.getPredictionCol(), (F.array_position("_each", F.array_max("_each")) - 1).cast("double"))
        made = made.withColumn(self.getProbabilityCol(), array_to_vector("_each"))
        return made.drop("_each", *[f"_{kind}_{k}" for kind in ("raw", "one") for k in range(len(both))])


def _margin(k: int) -> Column:
    return vector_to_array(f"_raw_{k}")[1]


@dataclass(frozen=True)
class OneAgainstRest:
    """A classifier of two classes, fitted once for each class, with calibrated probabilities.

    ``kernel`` features, if given, come before it. A share of the rows, chosen by a hash of their features, is kept from the
    fit: on their margins the sigmoids are fitted. Where rows come with a column ``_apart``, it says which.
    """

    binary: Estimator
    radial: bool = False
    features: int = 128
    calibration_share: float = 0.2
    parallelism: int = 4

    def kernel(self, inputs: int, input_col: str) -> list[Transformer]:
        return [RandomFourierFeatures(input_col, "features", inputs, self.features)] if self.radial else []

    def is_apart(self, features: Column) -> Column:
        return F.pmod(F.xxhash64(features), F.lit(1 << 20)) / float(1 << 20) < self.calibration_share

    def fit(self, vectors: DataFrame, label: str, weight: str | None = None) -> list[Transformer]:
        """The stages that take ``features`` to prediction and probability; ``weight`` names the column of the rows' weights."""
        if isinstance(self.binary, LinearSVC):
            return self._fit_lines(vectors, label, weight)
        rows = vectors if "_apart" in vectors.columns else vectors.withColumn("_apart", self.is_apart(vector_to_array("features")))
        classes = int(rows.agg(F.max(label)).first()[0]) + 1

        def one(k: int) -> tuple[Transformer, float, float]:
            own = rows.withColumn("_own", (F.col(label) == k).cast("double"))
            named = {"labelCol": "_own", "rawPredictionCol": f"_raw_{k}", "predictionCol": f"_one_{k}"}
            if self.binary.hasParam("probabilityCol"):
                named["probabilityCol"] = ""  # of two classes only, and not calibrated
            binary = self.binary.copy({self.binary.getParam(p): v for p, v in named.items()})
            binary = binary if weight is None else binary.setWeightCol(weight)
            read = ["_own"] + [weight] * (weight is not None)
            model = without_summary(binary.fit(own.filter("NOT _apart").select("features", *read)), vectors.sparkSession)
            apart = model.transform(own.filter("_apart").select("features", *read))
            return model, *sigmoid(apart.select(_margin(k).alias("margin"), *read), weight)

        with ThreadPoolExecutor(self.parallelism) as pool:
            fitted = list(pool.map(one, range(classes)))
        return [*[model for model, _, _ in fitted], CalibratedMargins([a for _, a, _ in fitted], [b for _, _, b in fitted])]

    def _fit_lines(self, vectors: DataFrame, label: str, weight: str | None) -> list[Transformer]:
        """Support vectors of all classes at once, by passes over the inputs that make kernel features anew: those are never kept."""
        spark, inputs = vectors.sparkSession, "scaled" if self.radial else "features"
        rows = vectors.select(
            vector_to_array(inputs).alias("inputs"), F.col(label).cast("int").alias("label"), (F.lit(1.0) if weight is None else F.col(weight)).alias("weight")
        ).withColumn("_apart", self.is_apart(F.col("inputs")))
        first = rows.agg(F.max("label"), F.max(F.size("inputs"))).first()
        classes, width = int(first[0]) + 1, int(first[1])
        kernel = self.kernel(width, inputs)
        named = {p: self.binary.getOrDefault(p) for p in ("maxIter", "regParam", "tol")}
        lines = fit_lines(rows.filter("NOT _apart"), classes, width, kernel[0] if kernel else None, **named)
        models = []
        for k, (slopes, intercept) in enumerate(lines):
            made = spark._jvm.org.apache.spark.ml.classification.LinearSVCModel(f"LinearSVC_{uuid.uuid4().hex[:12]}", _py2java(spark.sparkContext, Vectors.dense(slopes)), float(intercept))
            models.append(LinearSVCModel(made).setRawPredictionCol(f"_raw_{k}").setPredictionCol(f"_one_{k}"))
        apart = rows.filter("_apart").select(array_to_vector("inputs").alias(inputs), "label", "weight")
        scored = PipelineModel([*kernel, *models]).transform(apart)
        margins = scored.select("label", "weight", *[_margin(k).alias(f"m{k}") for k in range(classes)]).persist()
        try:
            fitted = [sigmoid(margins.select(F.col(f"m{k}").alias("margin"), (F.col("label") == k).cast("double").alias("_own"), "weight"), "weight") for k in range(classes)]
        finally:
            margins.unpersist()
        return [*models, CalibratedMargins([a for a, _ in fitted], [b for _, b in fitted])]


def fit_lines(
    rows: DataFrame, classes: int, width: int, kernel: RandomFourierFeatures | None, maxIter: int, regParam: float, tol: float
) -> list[tuple[np.ndarray, float]]:
    """For each class the line of least weighted mean hinge loss against the rest, with a penalty on slopes of features of unit deviation.

    ``rows`` have ``inputs``, ``label`` and ``weight``. It is what ``LinearSVC`` fits; here the classes share their passes over the rows.
    """
    flat = rows.select(*[F.col("inputs")[i].alias(f"_x{i}") for i in range(width)], "label", "weight").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fitted_lines(flat, classes, width, kernel, maxIter, regParam, tol)
    finally:
        flat.unpersist()


def _fitted_lines(
    flat: DataFrame, classes: int, width: int, kernel: RandomFourierFeatures | None, maxIter: int, regParam: float, tol: float
) -> list[tuple[np.ndarray, float]]:
    drawn = kernel.projections() if kernel else None
    size = len(drawn[1]) if drawn else width
    # Cosines in single precision, of which processors take many at once; rows are summed up in double.
    turns, shift = (np.ascontiguousarray(drawn[0].T, np.float32), drawn[1].astype(np.float32)) if drawn else (None, None)

    def features(inputs: np.ndarray) -> np.ndarray:
        return np.cos(inputs.astype(np.float32) @ turns + shift) * np.float32(np.sqrt(2 / size)) if drawn else inputs

    def summed(of: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all rows of what ``of`` gives for features, labels and weights of some."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                label, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight"))
                inputs = np.column_stack([batch.column(f"_x{i}").to_numpy(zero_copy_only=False) for i in range(width)])
                # Few rows at a time stay in the processor's cache.
                for i in range(0, len(label), 1024):
                    part = of(features(inputs[i : i + 1024]), label[i : i + 1024], weight[i : i + 1024])
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["total"])

        parts = flat.mapInArrow(work, "total array<double>").collect()
        return np.sum([r.total for r in parts], axis=0) if parts else np.zeros(1 + 2 * size)

    moments = summed(lambda z, _, w: np.concatenate([[w.sum()], w @ z, w @ (z * z).astype(np.float64)]))
    total, mean, square = moments[0], moments[1 : size + 1], moments[size + 1 :]
    if not total:
        return [(np.zeros(size), 0.0)] * classes
    spread = np.sqrt(np.maximum(square / total - (mean / total) ** 2, 0))
    unit = np.divide(1, spread, out=np.zeros(size), where=spread > 1e-12)

    def measured(points: Mapping[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        """Loss and gradient of each class at its point: slopes of features of unit deviation, then the intercept."""
        known = list(points)
        slopes, shifts = np.array([points[k][:-1] * unit for k in known]), np.array([points[k][-1] for k in known])

        def of(z: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
            side = np.where(label[:, None] == np.array(known), 1.0, -1.0)
            short = 1 - side * (z @ slopes.T.astype(z.dtype) + shifts)
            pull = np.where(short > 0, -side, 0.0) * weight[:, None]
            return np.concatenate([weight @ np.maximum(short, 0), (pull.T.astype(z.dtype) @ z).ravel(), pull.sum(0)])

        found = summed(of) / total
        n = len(known)
        by_slope, by_shift = found[n : n + n * size].reshape(n, size) * unit, found[n + n * size :]
        return {
            k: (found[i] + regParam / 2 * points[k][:-1] @ points[k][:-1], np.append(by_slope[i] + regParam * points[k][:-1], by_shift[i]))
            for i, k in enumerate(known)
        }

    searches = {k: _descend(np.zeros(size + 1), maxIter, tol) for k in range(classes)}
    points, ends = {k: next(search) for k, search in searches.items()}, {}
    while points:
        found, asked = measured(points), {}
        for k, value in found.items():
            try:
                asked[k] = searches[k].send(value)
            except StopIteration as end:
                ends[k] = end.value
        points = asked
    return [(ends[k][:-1] * unit, float(ends[k][-1])) for k in range(classes)]


def _descend(point: np.ndarray, rounds: int, tolerance: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """L-BFGS: asks for loss and gradient at points, returns the best. Ends when rounds gain less than the tolerance."""
    loss, slope = yield point
    moves, small = deque(maxlen=10), 0
    for _ in range(rounds):
        way, kept = -slope, []
        for s, y in reversed(moves):
            share = s @ way / (s @ y)
            kept.append(share)
            way = way - share * y
        if moves:
            s, y = moves[-1]
            way = way * (s @ y) / (y @ y)
        else:
            way = way / max(1.0, np.linalg.norm(way))
        for (s, y), share in zip(moves, reversed(kept)):
            way = way + (share - y @ way / (s @ y)) * s
        fall, step = slope @ way, 1.0
        if fall >= 0:
            way, fall = -slope, -(slope @ slope)
            moves.clear()
        if fall > -1e-14:
            break
        for _ in range(20):
            new_loss, new_slope = yield point + step * way
            if new_loss <= loss + 1e-4 * step * fall:
                break
            step /= 2
        else:
            break
        s, y = step * way, new_slope - slope
        if s @ y > 1e-12 * (y @ y):
            moves.append((s, y))
        small = small + 1 if loss - new_loss <= tolerance * max(abs(loss), abs(new_loss), 1e-12) else 0
        point, loss, slope = point + s, new_loss, new_slope
        if small >= 3:
            break
    return point


def sigmoid(margins: DataFrame, weight: str | None = None) -> tuple[float, float]:
    """Slope and intercept that make margins the most likely probabilities of ``_own``; the plain sigmoid without rows of both kinds."""
    counted = margins.agg(F.count_if(F.col("_own") == 1).alias("ones"), F.count_if(F.col("_own") == 0).alias("zeros")).first()
    if not counted.ones or not counted.zeros:
        return 1.0, 0.0
    rows = margins.select(array_to_vector(F.array("margin")).alias("features"), "_own", *[weight] * (weight is not None))
    curve = LogisticRegression(labelCol="_own", maxIter=100, regParam=1e-5, standardization=True)
    curve = (curve if weight is None else curve.setWeightCol(weight)).fit(rows)
    return max(float(curve.coefficients[0]), 1e-6), float(curve.intercept)
