from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from shapes import documents, hard_rows, words

from ridelake.llm import bbit
from ridelake.llm.components import components


def groups_of(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, width, percent):
    """``n_shingles`` and component of every document; ids have to be unique."""
    sets = {}
    for i, text, *_ in rows:
        own = (text or "").encode().lower().split()
        short = {tuple(own)} if own else set()
        sets[i] = frozenset(tuple(own[k : k + width]) for k in range(len(own) - width + 1)) if len(own) >= width else frozenset(short)
    holders, links = defaultdict(list), set()
    for i, own in sets.items():
        shared = defaultdict(int)
        for s in own:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        links |= {(i, j) for j, n in shared.items() if 100 * n >= percent * (len(own) + len(sets[j]) - n)}
    group = groups_of(links, sets)
    return {i: (len(sets[i]), group[i]) for i in sets}


def check(spark, rows, width=4, percent=80, **options):
    out = bbit.near_duplicates(documents(spark, rows), width=width, percent=percent, **options).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    assert got == brute(rows, width, percent) and len(out) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def edited(base, seed, edits):
    random_, out = random.Random(seed), base[:]
    for _ in range(edits):
        out[random_.randrange(len(out))] = f"e{random_.randrange(10**6)}"
    return out


def test_hard_rows(spark):
    rows = [r for r in hard_rows() if r[0] is not None]
    check(spark, rows[:9] + rows[10:])


def test_groups_of_every_tightness(spark):
    rows = []
    for k, edits in enumerate((1, 2, 4, 6, 8, 12)):
        base = words(k, 150, 10_000)
        rows += [(k * 100 + i, " ".join(edited(base, k * 100 + i, edits)), "en", "a") for i in range(40)]
    random.Random(1).shuffle(rows)
    check(spark, rows, block=16)
    check(spark, rows, width=5)


def test_a_chain_of_small_steps(spark):
    own, rows = words(7, 120, 10_000), []
    for i in range(30):
        own = edited(own, i, 3)
        rows.append((i * 7 % 30, " ".join(own), "en", "a"))
    check(spark, rows)


def test_copies_and_case(spark):
    text = " ".join(words(1, 50))
    rows = [(i, text.upper() if i % 2 else text, "en", "a") for i in range(60)] + [(60 + i, f"short {i % 3}", "en", "a") for i in range(9)]
    check(spark, rows)


def test_repeated_and_missing_ids(spark):
    text = " ".join(words(1, 50))
    rows = [(5, text, "en", "a"), (5, text, "en", "a"), (None, text, "en", "a"), (None, None, None, None), (7, text, "en", "a")]
    out = bbit.near_duplicates(documents(spark, rows), width=4).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out) == [
        ("5", "5", True), ("5", "5", True), ("7", "5", False), ("None", "None", True), ("None", "None", True),
    ]


def test_one_id_with_several_texts(spark):
    """Every text of an id keeps its own links, also where the id is the smallest of both."""
    a, b = words(1, 120, 10_000), words(2, 120, 10_000)
    rows = [(1, a), (1, b), (1, b), (2, edited(a, 3, 2)), (3, edited(b, 4, 2)), (4, a), (5, words(5, 60))]
    out = bbit.near_duplicates(documents(spark, [(i, " ".join(w), "en", "a") for i, w in rows]), width=4).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 5)]
    # 7 is linked with the one text of 5 and 8 with the other; these two groups have nothing in common.
    rows = [(5, a), (5, b), (7, edited(b, 6, 2)), (8, edited(a, 7, 2)), (2, edited(a, 8, 2))]
    out = bbit.near_duplicates(documents(spark, [(i, " ".join(w), "en", "a") for i, w in rows]), width=4).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(2, 2), (5, 2), (5, 5), (7, 5), (8, 2)]


def test_no_rows(spark):
    assert bbit.near_duplicates(documents(spark, [])).count() == 0
    check(spark, [(1, None, None, None), (2, "", "en", "a")])


def test_estimate_takes_chance_out():
    random_ = np.random.default_rng(0)
    by = bbit.multipliers(160)
    for share in (0.3, 0.8, 0.95):
        got = []
        for _ in range(60):
            pool = random_.integers(0, 2**63, 1000).astype(np.uint64)
            both = int(share * 1000)
            a, b = pool[: both + (1000 - both) // 2], np.concatenate([pool[:both], pool[both + (1000 - both) // 2 :]])
            bits = [np.frombuffer(bbit.packed_bits(bbit.minima(x, by)), np.uint8) for x in (a, b)]
            got.append(float(bbit.estimate(*bits)))
        assert np.mean(got) == pytest.approx(share, abs=0.02)


def test_components(spark):
    random_ = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(random_.randrange(100, 200), random_.randrange(100, 200)) for _ in range(60)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    df = spark.createDataFrame([*links, (None, 3), (7, 7)], "a long, b long")
    assert {r.node: r.component for r in components(df).collect()} == groups_of(links, nodes)
    assert components(df.where("false")).count() == 0


def test_registered_query(spark):
    from ridelake.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = QUERIES["op10_bbit_minhash"](spark, folder).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows, 4, 80)
