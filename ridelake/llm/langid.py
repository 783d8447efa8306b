"""Language identification by sparse multinomial logistic regression on character n-grams.

Texts become hashed counts of one to three letters (everything that is no letter is one blank),
weighted by TF-IDF and scaled to unit length. The weights are learned by follow-the-regularised-
leader with elastic-net penalties, which leaves most of them at exactly zero, and the scores are
divided by a temperature fitted on labelled rows that the weights have not seen.

Document frequencies cover every labelled row. Only the fit is done on a sample, of about
``fit_rows`` rows for each language, chosen by a hash of the id; its size does not depend on the table's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)  # odd
_SEEDS = np.array([0x27D4EB2F, 0x165667B1, 0x2545F491], np.uint32)


@cache
def _letters() -> np.ndarray:
    return np.array([chr(x).isalpha() for x in range(0x110000)])


def gram_codes(text: str, bits: int) -> np.ndarray | None:
    """Hashed n-grams of a text in order of appearance; null if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = _letters()[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, 0).astype(np.uint32)
    points = np.concatenate([[np.uint32(0)], points, [np.uint32(0)]])
    shift, parts, rolled = np.uint32(32 - bits), [], np.zeros(len(points), np.uint32)
    for n in range(3):
        rolled = (rolled[: len(points) - n] if n == 0 else rolled[:-1]) * _FACTORS[n] + points[n:] * _FACTORS[0] + _SEEDS[n]
        parts.append((rolled ^ rolled >> np.uint32(15)) * _FACTORS[2] >> shift)
    return np.concatenate(parts)


def features(text: str, idf: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Places and weights of the TF-IDF vector, of unit length."""
    codes = gram_codes(text, bits)
    if codes is None:
        return None
    counts = np.bincount(codes, minlength=1 << bits)
    at = np.flatnonzero(counts)
    x = (1 + np.log(counts[at])) * idf[at]
    return at, x / np.sqrt(x @ x)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # languages x features, mostly zero
    bias: np.ndarray
    idf: np.ndarray
    temperature: float
    bits: int

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text, self.idf, self.bits) if text and self.languages else None
        if found is None:
            return UNDETERMINED, 0.0
        at, x = found
        p = softmax((self.weights[:, at] @ x + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit_weights(rows: list[tuple], classes: int, size: int, *, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """FTRL-proximal over (places, weights, class); the last column is the unpenalised bias."""
    z, n = np.zeros((classes, size + 1)), np.zeros((classes, size + 1))

    def weights(at: np.ndarray) -> np.ndarray:
        za = z[:, at]
        w = -(za - np.sign(za) * l1) / ((beta + np.sqrt(n[:, at])) / alpha + l2)
        w[np.abs(za) <= l1] = 0
        return w

    order = np.random.default_rng(1)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x, own = rows[k]
            w = weights(at)
            bias = -z[:, size] / ((beta + np.sqrt(n[:, size])) / alpha)
            p = softmax(w @ x + bias)
            p[own] -= 1
            for place, value, now in ((at, np.outer(p, x), w), (size, p, bias)):
                square = value * value
                step = (np.sqrt(n[:, place] + square) - np.sqrt(n[:, place])) / alpha
                z[:, place] += value - step * now
                n[:, place] += square
    out = weights(np.arange(size + 1))
    out[:, size] = -z[:, size] / ((beta + np.sqrt(n[:, size])) / alpha)
    return out


def fit_temperature(scores: np.ndarray, own: np.ndarray) -> float:
    """The divisor of scores with the smallest negative log-likelihood, by a search on a fine grid."""
    if not len(own):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 241))
    losses = [-np.log(np.maximum(softmax(scores / t)[np.arange(len(own)), own], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def train(
    labelled: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    bits: int = 15,
    fit_rows: int = 1500,
    epochs: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.001,
) -> Model:
    """A model from the rows of ``labelled`` that have a language and a letter.

    What is fetched is bounded by the parameters: one number for each of the 2^``bits`` features and one
    weight for each of them and language.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    size = 1 << bits

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, seen = np.zeros(size + 1, np.int64), np.zeros(size, bool)
        for batch in batches:
            for text in batch["text"]:
                codes = gram_codes(text, bits)
                if codes is not None:
                    seen[:] = False
                    seen[codes] = True
                    df[:size] += seen
                    df[size] += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"feature": at.astype(np.int32), "df": df[at]})

    counted = rows.select("text").mapInPandas(frequencies, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(size + 1)
    df[counted["feature"]] = counted["df"]
    idf = np.log((1 + df[size]) / (1 + df[:size])) + 1

    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, size)), np.zeros(0), idf, 1.0, bits)
    share = F.create_map(*[F.lit(v) for k in languages for v in (k, min(1.0, fit_rows / sizes[k]))])[F.col("lang")]
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(place < share).withColumn("place", place)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t, idf, bits) for t in batch["text"]]
            keep = [i for i, x in enumerate(found) if x is not None]
            yield pd.DataFrame(
                {
                    "place": batch["place"].iloc[keep],
                    "lang": batch["lang"].iloc[keep],
                    "at": [found[i][0].astype(np.int32) for i in keep],
                    "x": [found[i][1] for i in keep],
                }
            )

    def fit(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["place", "lang"], kind="stable")
        every = [(np.asarray(a), np.asarray(x), languages.index(c)) for a, x, c in zip(table["at"], table["x"], table["lang"])]
        apart = every[::5]
        used = [r for i, r in enumerate(every) if i % 5] or every
        w = fit_weights(used, len(languages), size, epochs=epochs, alpha=alpha, beta=beta, l1=l1, l2=l2)
        scores = np.array([w[:, a] @ x + w[:, size] for a, x, _ in apart]).reshape(-1, len(languages))
        t = fit_temperature(scores, np.array([c for *_, c in apart], int))
        row, at = np.nonzero(w)
        out = pd.DataFrame({"class": row, "feature": at, "weight": w[row, at]})
        return pd.concat([out, pd.DataFrame({"class": [-1], "feature": [-1], "weight": [t]})])

    sampled = sample.select("text", "lang", "place").mapInPandas(vectors, "place double, lang string, at array<int>, x array<double>")
    learned = sampled.groupBy().applyInPandas(fit, "class int, feature int, weight double").toPandas()
    weights, temperature = np.zeros((len(languages), size + 1)), 1.0
    for c, at, w in learned.itertuples(index=False):
        if c < 0:
            temperature = w
        else:
            weights[c, at] = w
    if not len(learned):
        languages, weights = [], weights[:0]
    return Model(languages, weights[:, :size], weights[:, size], idf, temperature, bits)


def identify(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1) to every row, from the whole text alone.

    A null text and one without a letter are ``und`` with score 0, as is everything under a model that was
    given no labelled row. Columns of those two names are replaced.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    # Else a filter on the answer asks a second time, with a second Python worker beside the first in every task.
    predict = predict.asNondeterministic()
    others = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "_p")]
    answered = docs.withColumn("_p", predict(F.col(text_col).cast("string")))
    return answered.select(*[F.col(f"`{c}`") for c in others], "_p.lang_pred", "_p.score")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the id, as text, is divisible by ``folds``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def train_and_identify(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Learns from the rows outside the held-out fold and judges every row."""
    model = train(docs.where(~held_out(id_col) & F.col(id_col).isNotNull()), id_col=id_col, **options)
    return identify(docs.withColumn("held_out", held_out(id_col)), model)
