from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from ridelake.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, id string, label int, n string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None, None, None) for i, v in rows], SCHEMA)


def brute(rows, k, rounds, dim):
    """Plain integers, one vector at a time."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in named[:k]]
    if not centres:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, own in groups.items():
            centres[j] = [sum(c) // len(own) for c in zip(*own)]
    final = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in final)
    inertia = {j: sum(d for _, d, c in final if c == j) for j in range(k)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, inertia[j], total, digest[j]) for i, d, j in final), key=repr)


def clustered(spark, rows, **options):
    out = centroids.cluster(table(spark, rows), **options)
    return sorted((tuple(r[:6]) for r in out.collect()), key=repr)


@pytest.mark.parametrize("width", [1, 2, 3, 8])
def test_equals_brute_force(spark, width):
    random_ = random.Random(width)
    rows = [(i, [random_.gauss(0, 0.3) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)] + [rows[5], rows[5]]
    want = brute(rows, 7, 5, 8)
    for chunk in (16, 4096):
        assert clustered(spark, rows, k=7, dim=8, width=width, chunk_rows=chunk) == want


def test_rows_that_take_no_part(spark):
    random_ = random.Random(9)
    rows = [(i, [random_.gauss(0, 1) for _ in range(4)]) for i in range(30)]
    odd = [(100, None), (101, []), (102, [1.0] * 3), (103, [1.0] * 5), (104, [1.0, None, 1.0, 1.0]), (105, [math.nan] * 4), (106, [math.inf, 0.0, 0.0, 0.0])]
    odd += [(None, [0.5] * 4), (107, [-0.0, 0.0, -1e-9, 1e-9])]
    assert clustered(spark, rows + odd, k=5, dim=4) == brute(rows + odd, 5, 5, 4)
    assert clustered(spark, odd[:7], k=5, dim=4) == [] and clustered(spark, [], k=5, dim=4) == []
    assert clustered(spark, [(None, [0.5] * 4)], k=5, dim=4) == []


def test_ties_go_to_the_smaller_number_and_few_vectors(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(9)]
    assert clustered(spark, rows, k=4, dim=2) == brute(rows, 4, 5, 2)
    assert clustered(spark, rows[:2], k=40, dim=2) == brute(rows[:2], 40, 5, 2)


def test_components_beyond_64_bits_stay_exact(spark):
    rows = [(i, [float(2**40 + i * 2**20), float(i)]) for i in range(12)] + [(50, [1.0, 2.0])]
    got, want = clustered(spark, rows, k=3, dim=2), brute(rows, 3, 5, 2)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == [r[2] if r[2] < 2**63 else None for r in want]
    assert [r[5] for r in got] == [r[5] for r in want]


def test_dictionaries_lose_nothing():
    random_ = np.random.default_rng(0)
    for width in (1, 2, 5):
        block = np.floor(random_.normal(size=(500, width)) * 3) + 0.0
        entries, codes = centroids.encode_block(block)
        assert (entries[codes] == block).all() and len(np.unique(entries, axis=0)) == len(entries)
    pairs = np.array([[-centroids.SAFE, centroids.SAFE], [0, -1], [0, -1], [centroids.SAFE, -centroids.SAFE]], float)
    entries, codes = centroids.encode_block(pairs)
    assert (entries[codes] == pairs).all() and len(entries) == 3
