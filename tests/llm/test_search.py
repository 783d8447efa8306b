from __future__ import annotations

import math
import random

import numpy as np
import pytest
from ridelake.llm import vantage

SCHEMA = "vec_id long, embedding array<float>, rank int, score string, v string, query_id long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None, None) for i, v in rows], SCHEMA)


def brute(rows, asked, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok.setdefault(i, np.array(v, np.float32).astype(float))
    out = {}
    for q in asked:
        if q in ok:
            near = []
            for i, v in ok.items():
                if i != q and len(v) == len(ok[q]):
                    near.append((-vantage.cosines(ok[q][None], v[None])[0], i))
            out[q] = [i for _, i in sorted(near)[:k]]
    return out


@pytest.mark.parametrize("factor", [1.0])
def test_factor_one_is_exact(spark, factor):
    random_ = random.Random(5)
    rows = [(i, [random_.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 0.0, 0.0, 0.5]) for i in range(60)]  # one vector of many rows
    rows += [(2000 + i, [2.0, 4.0, 6.0, 0.0, 0.0, 1.0]) for i in range(3)]  # the same direction
    rows += [(3000, None), (3001, [0.0] * 6), (3002, [float("nan")] * 6), (3003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3004, [float("inf")] + [1.0] * 5)]
    rows += [(3005, [1.0, 2.0]), (3006, [2.0, 1.0]), (3007, []), (None, [1.0] * 6), (5, rows[5][1])]
    df = table(spark, rows)
    asked = [i for i, _ in rows if i is not None and i % 20 == 0] + [1001, 3000, 3001, 3002, 3005]
    found = vantage.nearest(df, df.where(df.vec_id.isin(asked)), k=5, factor=factor, shard_rows=64, block_rows=16, leaf=8)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got = {}
    for r in sorted(found.collect()):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: v for q, v in brute(rows, asked, 5).items() if v}


def test_relaxed_search_finds_most(spark):
    random_ = np.random.default_rng(1)
    points = random_.normal(size=(3000, 32))
    tree = vantage.VantageTree(points, 32, 1)
    exact, fast = vantage.Search(tree, points[:60], 6, 1.0), vantage.Search(tree, points[:60], 6, 4.0)
    full = set(zip(*map(np.ndarray.tolist, exact.pairs())))
    part = set(zip(*map(np.ndarray.tolist, fast.pairs())))
    assert len(full & part) >= 0.9 * len(full)
    assert fast.compared <= exact.compared


def test_no_rows(spark):
    empty = table(spark, [])
    assert vantage.nearest(empty, empty).count() == 0
    one = table(spark, [(50, [1.0, 2.0])])
    assert vantage.nearest(one, one).count() == 0


def test_registered_query_recall(spark):
    from ridelake.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    got = {}
    for r in QUERIES["op1_vantage_trees"](spark, folder).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert got.keys() == want.keys()
    assert sum(len(got[q] & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_tiny_and_huge_vectors_take_part(spark):
    """Finite and not zero is enough, even where a square would leave the range of doubles."""
    random_ = random.Random(8)
    rows = [(i, [random_.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    far = [(300, [1e-200 * x for x in rows[7][1]]), (301, [1e200 * x for x in rows[9][1]]), (302, [5e-324, 0.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + far, "vec_id long, embedding array<double>")
    found = vantage.nearest(df, df.where("vec_id % 50 = 0"), k=5, factor=1.0, shard_rows=64, block_rows=16).collect()
    assert len(found) == 7 * 5 and all(-1 - 1e-9 <= r.score <= 1 + 1e-9 for r in found)
    nearest = {r.query_id: r.vec_id for r in vantage.nearest(df, df.where("vec_id IN (7, 9)"), k=1, factor=1.0).collect()}
    assert nearest == {7: 300, 9: 301}
