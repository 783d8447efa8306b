"""Approximate nearest neighbours by cosine with one vantage-point tree per shard.

On unit vectors the euclidean distance orders like the cosine, and it is a metric, so the triangle
inequality holds: if all points below a node lie between ``near`` and ``far`` of its vantage point
``p``, none of them is closer to a query ``q`` than ``d(q, p) - far`` or ``near - d(q, p)``. The search
skips a node if ``factor`` times that bound exceeds the distance of the k-th neighbour found so far.
A factor of one is the exact search; larger ones skip more.

Shards are dealt by hash, so they are alike in size whatever the vectors are, and identical vectors
are indexed once, with as many of their ids as any query could need. Queries travel in blocks; each
pair of a shard and a block is one unit of work, whose memory depends on neither table's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridelake.llm.shared import pieces, stored

# Distances and bounds carry rounding errors of this order; what is closer is kept and decided exactly.
SLACK = 1e-7
ID_SALTS = 16


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the rows that take part: no null, non-finite or all-zero vector, no null id."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """Each distinct vector once, with the ``keep`` smallest of its ids: ``v, ids``.

    Equal vectors are equally near to everything, so with ties to the smaller id no query for k
    can return more than the k + 1 smallest (its own may be among them). Ids are cut down in
    salted parts first, so one vector that many rows share never meets in one task.
    """
    v = F.transform("v", lambda x: x + F.lit(0.0))
    parts = rows.select("id", v.alias("v")).distinct().withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(ID_SALTS)))
    part = Window.partitionBy("v", "_salt").orderBy("id")
    few = parts.withColumn("_n", F.row_number().over(part)).where(F.col("_n") <= keep)
    whole = Window.partitionBy("v").orderBy("id")
    fewer = few.withColumn("_n", F.row_number().over(whole)).where(F.col("_n") <= keep)
    return fewer.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


# One shard


class VantageTree:
    """Nodes in arrays; points of a leaf are a range of ``order``.

    A node's vantage point is the point farthest from a random one; its other points are halved by rank of
    distance, so equal distances cannot make a branch degenerate.
    """

    def __init__(self, points: np.ndarray, leaf: int, seed: int) -> None:
        self.points, self.leaf = points, leaf
        self.unit = unit_vectors(points)
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # (begin, end, vantage, inner, outer, inner range, outer range)
        self.random = np.random.default_rng(seed)
        todo = [(0, len(points), -1, 0)]
        while todo:
            begin, end, parent, side = todo.pop()
            at = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][3 + side] = at
            if end - begin <= leaf:
                self.nodes.append([begin, end, -1, -1, -1, None, None])
                continue
            own = self.order[begin:end]
            start = self.unit[own[self.random.integers(len(own))]]
            vantage = own[np.argmin(self.unit[own] @ start)]
            d = _apart(self.unit[own] @ self.unit[vantage])
            rank = np.argsort(d, kind="stable")
            self.order[begin:end] = own[rank]
            d, half = d[rank], (end - begin) // 2
            self.nodes.append([begin, end, vantage, -1, -1, (d[0], d[half - 1]), (d[half], d[-1])])
            todo += [(begin, begin + half, at, 0), (begin + half, end, at, 1)]


def _apart(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def brought_near_one(x: np.ndarray) -> np.ndarray:
    """Vectors times a power of two, which changes no digit of them, so that no square is too large or too small for a double."""
    _, exponent = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x, -exponent[:, None])


def unit_vectors(x: np.ndarray) -> np.ndarray:
    x = brought_near_one(x)
    return x / np.linalg.norm(x, axis=1)[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of paired rows on the original vectors, in double precision; the same for the same pair anywhere."""
    a, b = brought_near_one(a), brought_near_one(b)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


class Search:
    """The k nearest of every query of a block in one tree, for all queries of a node at a time."""

    def __init__(self, tree: VantageTree, queries: np.ndarray, keep: int, factor: float) -> None:
        self.tree, self.queries, self.keep, self.factor = tree, queries, keep, factor
        self.unit = unit_vectors(queries)
        self.bound = np.full(len(queries), np.inf)  # distance of the k-th best so far
        self.best = np.full((len(queries), keep), np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.compared = 0
        self._visit(0, np.arange(len(queries)))

    def _leaf(self, begin: int, end: int, q: np.ndarray) -> None:
        own = self.tree.order[begin:end]
        self.compared += len(own) * len(q)
        d = _apart(self.unit[q] @ self.tree.unit[own].T)
        best = np.sort(np.concatenate([self.best[q], d], axis=1), axis=1)[:, : self.keep]
        self.best[q], self.bound[q] = best, best[:, -1]
        row, column = np.nonzero(d <= self.bound[q][:, None] + SLACK)
        self.found.append((q[row], own[column]))

    def _visit(self, node: int, q: np.ndarray) -> None:
        if not len(q):
            return
        begin, end, vantage, inner, outer, near, far = self.tree.nodes[node]
        if vantage < 0:
            self._leaf(begin, end, q)
            return
        d = _apart(self.unit[q] @ self.tree.unit[vantage])
        first = d <= (near[1] + far[0]) / 2
        for child, span, own in ((inner, near, first), (outer, far, ~first), (outer, far, first), (inner, near, ~first)):
            some, at = q[own], d[own]
            apart = np.maximum(np.maximum(at - span[1], span[0] - at), 0.0)
            self._visit(child, some[self.factor * apart <= self.bound[some] + SLACK])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of queries and points that are among the k nearest or tie with the last within the slack."""
        q = np.concatenate([x for x, _ in self.found]) if self.found else np.empty(0, int)
        p = np.concatenate([x for _, x in self.found]) if self.found else np.empty(0, int)
        d = _apart(np.einsum("ij,ij->i", self.unit[q], self.tree.unit[p]))
        near = d <= self.bound[q] + 2 * SLACK
        return q[near], p[near]


# Spark


def _packed(rows: pd.DataFrame) -> np.ndarray:
    return np.stack(rows["v"].to_numpy()).astype(np.float64)


def vantage_index(distinct: DataFrame, shard_rows: int, leaf: int) -> DataFrame:
    """One row per shard (and vector length): its tree, written to the shared folder."""
    shards = pieces(distinct.count(), shard_rows)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        import pickle

        rows = rows.sort_values("first_id")
        tree = VantageTree(_packed(rows), leaf, seed=len(rows))
        ids = [list(map(int, x)) for x in rows["ids"]]
        return pd.DataFrame({"dim": [int(rows["dim"].iloc[0])], "shard": [int(rows["shard"].iloc[0])], "tree": [pickle.dumps((tree, ids), 5)]})

    keyed = distinct.select("v", "ids", F.col("ids")[0].alias("first_id"), F.size("v").alias("dim"))
    keyed = keyed.withColumn("shard", F.pmod(F.xxhash64("first_id"), F.lit(shards)).cast("int"))
    return stored(keyed.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, tree binary"), "vantage-trees")


def query_blocks(queries: DataFrame, block_rows: int) -> DataFrame:
    """Queries (``id, v``) as rows of packed blocks, one vector length in each."""
    blocks = pieces(queries.count(), block_rows)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        packed = {"ids": [rows["id"].to_numpy(np.int64).tobytes()], "vectors": [_packed(rows).tobytes()]}
        return pd.DataFrame({"dim": [int(rows["dim"].iloc[0])], "block": [int(rows["block"].iloc[0])], **packed})

    keyed = queries.withColumns({"dim": F.size("v"), "block": F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")})
    return keyed.groupBy("dim", "block").applyInPandas(pack, "dim int, block int, ids binary, vectors binary")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 5,
    factor: float = 4.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = 8192,
    block_rows: int = 2048,
    leaf: int = 64,
) -> DataFrame:
    """The k nearest rows of ``vectors`` for each row of ``queries``: ``query_id, rank, vec_id, score``.

    ``score`` is the cosine of the original vectors in double precision; nearest first, ties to the
    smaller id; fewer rows if there are fewer candidates. A query's own id is no candidate. Vectors
    that are null, zero or hold null or non-finite components take no part on either side, nor do rows
    without an id; vectors of different lengths are never compared. Rows repeated in every column
    count once; a query id with several vectors is answered for each of them and the best ``k`` stay. Empty tables
    give no rows; other columns are not read. ``factor`` of 1 is exact; see the module's text.
    """
    import pickle

    distinct = stored(distinct_vectors(usable(vectors, id_col, vector_col), k + 1), "vantage-distinct")
    index = vantage_index(distinct, shard_rows, leaf)
    blocks = query_blocks(usable(queries, id_col, vector_col).distinct(), block_rows)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x in batch.itertuples():
                tree, ids = pickle.loads(x.tree)
                own = np.frombuffer(x.ids, np.int64)
                asked = np.frombuffer(x.vectors, np.float64).reshape(len(own), x.dim)
                q, p = Search(tree, asked, k + 1, factor).pairs()
                score = cosines(asked[q], tree.points[p])
                times = np.fromiter((len(ids[i]) for i in p), np.int64, len(p))
                out = pd.DataFrame(
                    {
                        "query_id": np.repeat(own[q], times),
                        "vec_id": np.fromiter((y for i in p for y in ids[i]), np.int64, int(times.sum())),
                        "score": np.repeat(score, times),
                    }
                )
                out = out[out["query_id"] != out["vec_id"]].drop_duplicates()
                out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
                yield out[out.groupby("query_id").cumcount() < k]

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        blocks.join(index, "dim")
        .repartition(F.col("dim"), F.col("block"), F.col("shard"))
        .mapInPandas(search, "query_id long, vec_id long, score double")
        .distinct()
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
