"""Centroid clustering of integer vectors over dictionary-encoded subvectors.

Vectors are cut into chunks of rows, and their dimensions into blocks of ``width``. A chunk is stored without loss as
one dictionary of distinct subvectors for each block and one code for each vector and block. A round computes the exact
squared distance of every dictionary entry to every centroid's block once; a vector's distance is the sum of its
codes' partial distances. Sums of a cluster come from counts of (cluster, code) in the same way. Chunks are bounded
by ``chunk_rows``, so memory is too, whether entries repeat or not; tasks work on chunks alone and send
one row a cluster and dimension.

All arithmetic is on integers. Where components are so large that squares could leave 64 bits, Python's integers take
over; a distance that does not fit a long is null.

Results of special cases: vectors that are null, of another length, or hold a null or non-finite component (also one whose
``scale``-fold is not finite) take no part and have no row. Repeated rows count, and are returned, as often
as they come; of rows with one id the smaller vector is first among the starting centroids. A null id cannot
start a centroid but is clustered. With fewer vectors than ``k`` there are as many centroids as vectors; without any, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.shared import stored

# Up to this magnitude 64 squared differences add up within 63 bits.
SAFE = 1 << 27
_SLICE = 2_048


def integers(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), still as doubles: exact, as the scale is a power of two; no negative zero."""
    with np.errstate(over="ignore"):
        return np.floor(values * scale) + 0.0


def usable_vectors(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold exactly ``dim`` finite components, and these as a matrix of doubles."""
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dim)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64()) if len(rows) else pa.array([], pa.float64())
    matrix = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)  # nulls become NaN
    finite = np.isfinite(matrix).all(axis=1)
    return rows[finite], matrix[finite]


def exact(values: np.ndarray, safe: bool) -> np.ndarray:
    if safe:
        return values.astype(np.int64)
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def encode_block(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a block, and the code of each row."""
    if block.shape[1] == 2 and np.abs(block).max() <= SAFE:
        # Pairs of small integers are told apart by one number.
        pairs = block.astype(np.int64)
        packed, codes = np.unique((pairs[:, 0] << 32) + (pairs[:, 1] + (1 << 31)), return_inverse=True)
        return np.stack([packed >> 32, (packed & 0xFFFFFFFF) - (1 << 31)], axis=1).astype(float), codes
    entries, codes = np.unique(block, axis=0, return_inverse=True)
    return entries, codes.ravel()


def encode(vectors: DataFrame, *, id_col: str, vector_col: str, dim: int, scale: float, width: int, chunk_rows: int) -> DataFrame:
    """One row per chunk: ids, largest magnitude, dictionaries of the blocks and codes of the vectors."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        parts: list[np.ndarray] = []
        waiting = 0

        def row() -> pa.RecordBatch:
            matrix = np.concatenate(parts)
            names = pa.concat_arrays(ids)
            dictionaries, codes = [], []
            for at in range(0, dim, width):
                entries, own = encode_block(matrix[:, at : at + width])
                dictionaries.append(entries.tobytes())
                codes.append(own.astype(np.uint16 if len(entries) <= 1 << 16 else np.uint32).tobytes())
            columns = [
                pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                pa.array([float(np.abs(matrix).max())], pa.float64()),
                pa.array([dictionaries], pa.list_(pa.binary())),
                pa.array([codes], pa.list_(pa.binary())),
            ]
            ids.clear()
            parts.clear()
            return pa.RecordBatch.from_arrays(columns, ["ids", "magnitude", "dictionaries", "codes"])

        for batch in batches:
            kept, matrix = usable_vectors(batch.column("vector"), dim)
            matrix = integers(matrix, scale)
            finite = np.isfinite(matrix).all(axis=1)
            names = batch.column("id").take(pa.array(kept[finite]))
            matrix, at = matrix[finite], 0
            while at < len(matrix):
                until = min(len(matrix), at + chunk_rows - waiting)
                ids.append(names.slice(at, until - at))
                parts.append(matrix[at:until])
                waiting += until - at
                at = until
                if waiting == chunk_rows:
                    yield row()
                    waiting = 0
        if waiting:
            yield row()

    return rows.mapInArrow(chunks, f"ids array<{kind}>, magnitude double, dictionaries array<binary>, codes array<binary>")


def _open(chunk: dict, width: int, dim: int, safe: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
    dictionaries, codes = [], []
    for b, at in enumerate(range(0, dim, width)):
        entries = np.frombuffer(chunk["dictionaries"][b], np.float64).reshape(-1, min(width, dim - at))
        dictionaries.append(exact(entries, safe))
        codes.append(np.frombuffer(chunk["codes"][b], np.uint16 if len(entries) <= 1 << 16 else np.uint32))
    return dictionaries, codes


def assign(dictionaries: list[np.ndarray], codes: list[np.ndarray], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every vector of a chunk, ties to the smaller number, and the squared distance."""
    tables, at = [], 0
    for entries in dictionaries:
        own = centroids[:, at : at + entries.shape[1]]
        # One centroid at a time: a table is entries x centroids, its differences are not kept.
        tables.append(np.stack([((entries - c) ** 2).sum(axis=1) for c in own], axis=1))
        at += entries.shape[1]
    n = len(codes[0])
    nearest, distance = np.empty(n, np.int32), np.empty(n, tables[0].dtype)
    for lo in range(0, n, _SLICE):
        total = tables[0][codes[0][lo : lo + _SLICE]]
        for table, own in zip(tables[1:], codes[1:]):
            total += table[own[lo : lo + _SLICE]]
        nearest[lo : lo + _SLICE] = total.argmin(axis=1)
        distance[lo : lo + _SLICE] = total.min(axis=1)
    return nearest, distance


def cluster_sums(dictionaries: list[np.ndarray], codes: list[np.ndarray], nearest: np.ndarray, k: int) -> np.ndarray:
    """Sums of the vectors of each cluster, from counts of (cluster, code)."""
    parts = []
    for entries, own in zip(dictionaries, codes):
        counts = np.bincount(nearest.astype(np.int64) * len(entries) + own, minlength=k * len(entries)).reshape(k, -1)
        parts.append(counts.astype(entries.dtype) @ entries)
    return np.concatenate(parts, axis=1)


def _sums_of_round(chunks: DataFrame, centroids: list[list[int]], dim: int, width: int) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of every cluster that has vectors."""
    k = len(centroids)
    largest = max(abs(v) for c in centroids for v in c)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(k, np.int64), [[0] * dim for _ in range(k)]
        for batch in batches:
            for chunk in batch.to_pylist():
                safe = max(chunk["magnitude"], largest) <= SAFE
                dictionaries, codes = _open(chunk, width, dim, safe)
                nearest, _ = assign(dictionaries, codes, np.array(centroids, np.int64 if safe else object))
                counts += np.bincount(nearest, minlength=k)
                for c, row in enumerate(cluster_sums(dictionaries, codes, nearest, k).tolist()):
                    totals[c] = [a + b for a, b in zip(totals[c], row)]
        held = [(c, d, v) for c in range(k) if counts[c] for d, v in enumerate([int(counts[c]), *totals[c]])]
        if held:
            c, d, v = zip(*held)
            columns = [pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array([str(x) for x in v], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["c", "d", "v"])

    sent = chunks.select("magnitude", "dictionaries", "codes").mapInArrow(work, "c int, d int, v string")
    summed = sent.groupBy("c", "d").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    table: dict[int, dict[int, int]] = {}
    for r in summed:
        table.setdefault(r.c, {})[r.d] = int(r.v)
    return {c: (row[0], [row[d] for d in range(1, dim + 1)]) for c, row in table.items()}


def starting_centroids(vectors: DataFrame, *, id_col: str, vector_col: str, dim: int, scale: float, k: int, seed: int) -> list[list[int]]:
    """The vectors whose ``seed:id`` has the smallest SHA-256 in hexadecimal, in that order."""
    v, x = F.col("vector"), F.col("x")
    named = vectors.select(F.col(id_col).cast("string").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & (F.size(v) == dim)
    )
    scaled = named.select(
        F.sha2(F.concat(F.lit(f"{seed}:"), "id").cast("binary"), 256).alias("h"), F.transform(v, lambda c: c * scale).alias("x")
    ).where(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return [[int(c) for c in integers(np.array(r.x), 1.0)] for r in scaled.orderBy("h", "x").limit(k).collect()]


@dataclass
class Clustering:
    """Centroids in the order of their numbers, and the encoded vectors they were made from."""

    centroids: list[list[int]]
    chunks: DataFrame
    dim: int
    width: int


def fit(
    vectors: DataFrame,
    *,
    k: int = 40,
    rounds: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dim: int = 64,
    scale: float = 256.0,
    width: int = 2,
    seed: int = 2,
    chunk_rows: int = 16_384,
) -> Clustering:
    """Centroids after ``rounds`` rounds, each of which makes them the componentwise floor of their vectors' mean.

    ``scale`` is a power of two. Fetched are k times dim numbers a round.
    """
    options = {"id_col": id_col, "vector_col": vector_col, "dim": dim, "scale": scale}
    chunks = stored(encode(vectors, width=width, chunk_rows=chunk_rows, **options), "subvectors")
    centroids = starting_centroids(vectors, k=k, seed=seed, **options)
    if centroids:
        for _ in range(rounds):
            for c, (n, sums) in _sums_of_round(chunks, centroids, dim, width).items():
                centroids[c] = [s // n for s in sums]
    return Clustering(centroids, chunks, dim, width)


def label(fitted: Clustering) -> DataFrame:
    """``id, cluster, distance`` of every vector that takes part."""
    centroids, dim, width = fitted.centroids, fitted.dim, fitted.width
    largest = max((abs(v) for c in centroids for v in c), default=0)
    kind = fitted.chunks.schema["ids"].dataType.elementType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if centroids else ():
            for i, chunk in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                safe = max(chunk["magnitude"], largest) <= SAFE
                dictionaries, codes = _open(chunk, width, dim, safe)
                nearest, distance = assign(dictionaries, codes, np.array(centroids, np.int64 if safe else object))
                fitting = distance if safe else [_long(d) for d in distance.tolist()]
                ids = batch.column("ids").slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays([ids, pa.array(nearest), pa.array(fitting, pa.int64())], ["id", "cluster", "distance"])

    return fitted.chunks.mapInArrow(work, f"id {kind}, cluster int, distance long")


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None


def cluster(vectors: DataFrame, *, id_col: str = "vec_id", **options) -> DataFrame:
    """One row per vector: id, cluster, squared distance, inertia of its cluster and of all, its centroid's digest and size."""
    fitted = fit(vectors, id_col=id_col, **options)
    labelled = stored(label(fitted), "labelled")
    measured = labelled.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"), F.count("*").alias("n")).collect()
    total = sum(int(r.inertia or 0) for r in measured)
    digest = {r.cluster: hashlib.sha256(",".join(map(str, fitted.centroids[r.cluster])).encode()).hexdigest() for r in measured}
    # One row a cluster: at most k.
    known = vectors.sparkSession.createDataFrame(
        [(r.cluster, _long(int(r.inertia or 0)), _long(total), digest[r.cluster], r.n) for r in measured],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, cluster_size long",
    )
    return labelled.withColumnRenamed("id", id_col).join(F.broadcast(known), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "cluster_size"
    )
