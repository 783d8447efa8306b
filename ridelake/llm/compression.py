"""Quality scores by compression: a text is good if a dictionary of good texts makes it smaller than one of bad texts does.

Two Zstandard dictionaries are built from pieces of labelled texts. Every text is compressed with both, in pieces of
``piece_bytes``, so that what helps is the dictionary and not the text's own beginning, and so that long texts
take no more memory than short ones. The difference of the compressed sizes by the size of the text becomes a
probability through a logistic curve, fitted on labelled rows that the dictionaries have not seen.

Learned from is a sample of about ``fit_rows`` rows of each label, chosen by a hash of the id, and of these about
``fit_bytes`` bytes in pieces from anywhere in the texts: a bound that does not grow with the table. Rows of the curve are
weighted so that the sample's shares of labels are those of all labelled rows. Every text is scored whole.

Results of special cases: null and empty texts have no difference and get the curve's value there. Labels other than 0 and 1,
those without an id and those of unknown documents teach nothing; one id with both labels counts for both. With no label, or
one kind only, all rows score the smoothed share of label 1. A null id is never held out and never learned from. Columns
``held_out``, ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.shared import stored

LEVEL = 3
_PLACES = 1 << 30


def cut(text: bytes, piece_bytes: int) -> Iterator[bytes]:
    return (text[at : at + piece_bytes] for at in range(0, len(text), piece_bytes))


def build_dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary trained on samples; of too few to train on, the last ``size`` bytes of them."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """Frames hold nothing but what is compressed: no checksum, size or dictionary number."""
    bare = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, **bare)
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=known, **bare)


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float
    intercept: float
    piece_bytes: int
    _pair: tuple | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pair": None}

    def difference(self, text: bytes | None) -> float:
        """How many bytes the good dictionary saves against the bad one, per byte of text."""
        if not text:
            return 0.0
        if self._pair is None:
            self._pair = compressor(self.good), compressor(self.bad)
        good, bad = self._pair
        saved = sum(len(bad.compress(p)) - len(good.compress(p)) for p in cut(text, self.piece_bytes))
        return saved / len(text)

    def score(self, text: bytes | None) -> float:
        return float(logistic(self.slope * self.difference(text) + self.intercept))


def logistic(x: np.ndarray | float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def fit_curve(x: np.ndarray, label: np.ndarray, weight: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and intercept of the most likely rising logistic curve, by Newton's method with a slight ridge.

    Labels are pulled towards one another by one row of each kind, so that separable rows give no endless slope.
    """
    flat = 0.0, float(np.log(prior / (1 - prior)))
    if len(np.unique(label)) < 2:
        return flat
    ones, zeros = weight[label == 1].sum(), weight[label == 0].sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    spread = max(float(x.std()), 1e-12)
    columns = np.stack([x / spread, np.ones_like(x)], axis=1)
    at = np.array([0.0, flat[1]])

    def loss(b: np.ndarray) -> float:
        z = columns @ b
        return float(weight @ (np.logaddexp(0, z) - target * z)) + 5e-7 * float(b @ b)

    for _ in range(100):
        p = logistic(columns @ at)
        slope = columns.T @ (weight * (p - target)) + 1e-6 * at
        bend = (columns * (weight * p * (1 - p))[:, None]).T @ columns + 1e-6 * np.eye(2)
        step, share = np.linalg.solve(bend, slope), 1.0
        while share > 1e-6 and loss(at - share * step) > loss(at):
            share /= 2
        at = at - share * step
        if np.abs(share * step).max() < 1e-9:
            break
    return (float(at[0] / spread), float(at[1])) if at[0] > 0 else flat


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the id, as text, leaves ``fold`` when divided by ``folds``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _place(*columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(_PLACES)) / float(_PLACES)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    learnable: Column | None = None,
    fit_rows: int = 6_000,
    fit_bytes: int = 8 << 20,
    dictionary_bytes: int = 32_768,
    piece_bytes: int = 1_024,
) -> Model:
    """A model from the labelled rows for which ``learnable`` holds (all, if not given).

    Fetched are two dictionaries and about ``fit_rows / 5`` numbers of each label. The ids of the sample, twice ``fit_rows``
    of a few bytes at most, are broadcast: no text is shuffled for the join.
    """
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    usable = named.where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    if learnable is not None:
        usable = usable.withColumnRenamed("id", id_col).where(learnable).withColumnRenamed(id_col, "id")
    sizes = {r.label: r.n for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = [min(1.0, fit_rows / sizes[q]) if sizes.get(q) else 0.0 for q in (0, 1)]
    chosen = usable.where(_place("id") < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).where("id IS NOT NULL AND octet_length(text) > 0")
    sample = stored(texts.join(F.broadcast(chosen), "id").withColumn("apart", _place("id", F.lit("apart")) < 0.2), "labelled")
    prior = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)

    taught = {r.label: r.n for r in sample.where("NOT apart").groupBy("label").agg(F.sum(F.octet_length("text").cast("long")).alias("n")).collect()}
    if len(taught) < 2:
        return Model(b"", b"", 0.0, float(np.log(prior / (1 - prior))), piece_bytes)
    kept = {q: min(1.0, fit_bytes / n) for q, n in taught.items()}

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, text, q in zip(batch["id"], batch["text"], batch["label"]):
                rows = []
                for i, piece in enumerate(cut(text, piece_bytes)):
                    place = xxhash.xxh3_64_intdigest(f"{name}:{i}".encode())
                    if place < kept[q] * 2.0**64:
                        rows.append((q, f"{place:016x}", piece))
                yield pd.DataFrame(rows, columns=["label", "place", "piece"])

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["place", "piece"], kind="stable")
        return pd.DataFrame({"label": group["label"].iloc[:1], "dictionary": [build_dictionary(list(group["piece"]), dictionary_bytes)]})

    parts = sample.where("NOT apart").select(F.col("id").cast("string"), "text", "label")
    cuts = parts.mapInPandas(pieces, "label int, place string, piece binary")
    # A group holds about fit_bytes.
    built = {r.label: bytes(r.dictionary) for r in cuts.groupBy("label").applyInPandas(build, "label int, dictionary binary").collect()}
    model = Model(built.get(1, b""), built.get(0, b""), 1.0, 0.0, piece_bytes)

    @F.pandas_udf("double")
    def difference(column: pd.Series) -> pd.Series:
        return column.map(model.difference)

    seen = sample.where("apart").select("id", "label", difference("text").alias("x")).toPandas().sort_values(["x", "label"])
    label = seen["label"].to_numpy()
    weight = np.where(label == 1, 1 / (share[1] or 1), 1 / (share[0] or 1))
    model.slope, model.intercept = fit_curve(seen["x"].to_numpy(float), label, weight, prior)
    return model


def score(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Adds ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` to every row, from the whole text alone."""

    @F.pandas_udf("double")
    def judged(column: pd.Series) -> pd.Series:
        return column.map(model.score, na_action=None)

    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = docs.select(*others, judged(F.col(text_col).cast("string").cast("binary")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def train_and_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Learns from the labels outside the held-out fold and scores every row."""
    model = train(docs, labels, id_col=id_col, learnable=~held_out(id_col), **options)
    return score(docs.withColumn("held_out", held_out(id_col)), model)
