from __future__ import annotations

import re
from collections import Counter

import pytest
from shapes import documents, hard_rows

from ridelake.llm import pfair


def mixture(spark, sizes, **options):
    rows = [(k * 10_000 + i, "t", "en", source) for k, (source, n) in enumerate(sizes.items()) for i in range(n)]
    df = documents(spark, rows)
    out = sorted(pfair.mix(df, **options).collect(), key=lambda r: r.place)
    assert Counter(r.doc_id for r in out) == Counter(i for i, *_ in rows)
    assert len({r.place for r in out}) == len(rows)
    return out, df


def earliest_deadline_first(quota):
    """The schedule of a cycle, one slot after the other."""
    slots, done, out = sum(quota), [0] * len(quota), []
    for t in range(slots):
        ready = [(-(-(done[i] + 1) * slots // q), i) for i, q in enumerate(quota) if done[i] < q and done[i] * slots // q <= t]
        due, i = min(ready)
        assert t < due
        done[i] += 1
        out.append(i)
    return out


@pytest.mark.parametrize(
    "weights", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 0.9, "b": 0.05, "c": 0.05}, {"a": 1, "b": 1, "c": 1}, {"a": 1}, {"a": -1, "b": 0}]
)
def test_deviation_stays_below_a_block(spark, weights):
    sizes = {"a": 900, "b": 400, "c": 350}
    out, df = mixture(spark, sizes, weights=weights, cycle=37, block_rows=5, chunk_rows=100)
    quota = {r.source: r.q for r in pfair.quotas(df, "source", weights, 0.5, 37).collect()}
    total, names = sum(quota.values()), sorted(quota)
    took = {r.slot: r.source for r in out}
    cycle = [names[i] for i in earliest_deadline_first([quota[n] for n in names])]
    assert all(cycle[slot % total] == source for slot, source in took.items())
    had = Counter()
    for t in range(min(sizes[s] // 5 * total // quota[s] for s in sizes)):
        had[took[t]] += 1
        assert all(abs(had[s] - (t + 1) * quota[s] / total) < 1 for s in sizes)


def test_order_within_a_source_and_blocks(spark):
    out, _ = mixture(spark, {"a": 103, None: 40, "": 11}, block_rows=4, chunk_rows=10)
    for source in ("a", None, ""):
        own = [r for r in out if r.source == source]
        assert [r.block for r in own] == [i // 4 for i in range(len(own))]
    assert out == sorted(mixture(spark, {"a": 103, None: 40, "": 11}, block_rows=4, chunk_rows=10)[0], key=lambda r: r.place)


def test_chunks_do_not_change_shares(spark):
    for rows in (1, 50, 10_000):
        out, _ = mixture(spark, {"a": 200, "b": 50}, block_rows=1, chunk_rows=rows, cycle=10)
        assert [r.slot for r in out] == [r.place for r in out]


def test_many_sources_take_the_shuffled_way(spark, monkeypatch):
    few, _ = mixture(spark, {"a": 60, "b": 30, "c": 10}, block_rows=2)
    monkeypatch.setattr(pfair, "BROADCAST_SOURCES", 1)
    many, _ = mixture(spark, {"a": 60, "b": 30, "c": 10}, block_rows=2)
    assert few == many


def test_hard_rows(spark):
    df = documents(spark, hard_rows())
    out = pfair.mix(df)
    assert out.columns == [c for c in df.columns if c not in pfair.ADDED] + list(pfair.ADDED)
    assert out.count() == df.count()
    assert pfair.mix(documents(spark, [])).count() == 0
    assert not re.search("Python|Pandas|Arrow", pfair.in_order(out)._jdf.queryExecution().toString())


def test_laid_out_in_order(spark, folder):
    _, df = mixture(spark, {"a": 300, "b": 200})
    mixed = pfair.mix(df)
    pfair.in_order(mixed).write.parquet(folder)
    files = spark.read.parquet(folder).selectExpr("_metadata.file_name AS f", "place").collect()
    bounds = sorted((min(p), max(p)) for p in ([r.place for r in files if r.f == f] for f in {r.f for r in files}))
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_registered_query(spark):
    from ridelake.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    out = QUERIES["op9_pfair_mixture"](spark, folder).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    df = spark.read.parquet(f"{folder}/documents.parquet")
    quota = {r.source: (r.n, r.q) for r in pfair.quotas(df, "source", None, 0.5, 1000).collect()}
    total = sum(q for _, q in quota.values())
    took, had = {r.slot: r.source for r in out}, Counter()
    for t in range(min(n // 16 * total // q for n, q in quota.values())):
        had[took[t]] += 1
        assert all(abs(had[s] - (t + 1) * q / total) < 1 for s, (_, q) in quota.items())
