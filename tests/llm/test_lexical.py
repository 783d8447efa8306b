from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from shapes import documents, hard_rows

from ridelake.llm import nra

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(A_TO_Z))


def brute(rows, items, k=10):
    """Every document scored for every item."""
    held = [(r[0], Counter(terms(r[1]))) for r in rows]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for (name, c), n in zip(held, sizes):
            score = 0
            for t in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * n * n_docs) // total
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, name is None, name or 0, name))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def items(spark, rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], "item_id long, text string, rank string, score string")


def found(spark, rows, asked, **options):
    out = nra.search(documents(spark, rows), items(spark, asked), **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=repr)


def corpus(n, seed, vocabulary=60):
    """Skewed words, so that some terms are in nearly all documents."""
    random_ = random.Random(seed)
    return [
        (i, " ".join(f"W{int(vocabulary * random_.random() ** 3)}" for _ in range(random_.randrange(1, 60))), "en", "a") for i in range(n)
    ]


def test_equals_brute_force_in_shards_of_any_size(spark):
    rows = corpus(400, 1)
    asked = [(i, " ".join(f"w{x}," for x in range(i, 60, i + 1))) for i in range(12)] + [(90, None), (91, ""), (92, "absent"), (93, "w1 W1 w1"), (93, "w1 W1 w1")]
    want = brute(rows, asked)
    for size in (1, 300, 4_000_000):
        assert found(spark, rows, asked, shard_postings=size) == want
    assert found(spark, rows, asked, block_items=3) == want
    assert found(spark, rows, asked, k=3) == brute(rows, asked, 3)


def test_ties_and_copies(spark):
    rows = [(i, "same words here", "en", "a") for i in range(300, 0, -1)] + [(7, "same words here", "en", "a"), (None, "same words here", "en", "a")]
    rows += corpus(50, 2)
    asked = [(1, "same words"), (2, "w3 here")]
    assert found(spark, rows, asked) == brute(rows, asked)
    few = [(None, "one", "en", "a"), (4, "one", "en", "a"), (5, "two", "en", "a")]
    assert [r[2] for r in sorted(found(spark, few, [(1, "one")]), key=lambda r: r[1])] == [4, None]


def test_hard_rows(spark):
    rows = hard_rows()
    asked = [(1, "w1 w2 w3 café 日本語"), (2, "naïve ONE two"), (3, "!!"), (None, "same changed")]
    assert found(spark, rows, asked) == brute(rows, asked)
    assert found(spark, [], asked) == [] and found(spark, rows, []) == []
    assert found(spark, [(1, None, "en", "a"), (2, "--", "en", "a")], asked) == []


def test_terms_of_long_texts_come_in_slices(monkeypatch):
    monkeypatch.setattr(nra, "SLICE_BYTES", 16)
    random_ = random.Random(3)
    for _ in range(300):
        text = "".join(random_.choice("aB9 .é\x00日\n") for _ in range(random_.randrange(0, 120)))
        assert [t.decode() for part in nra.term_slices(text.encode()) for t in part] == terms(text)
    assert [len(t) for part in nra.term_slices(b"a" * 1000) for t in part] == [1000]


def test_a_text_of_50_mb_is_counted_whole():
    text = (b"alpha Beta gamma " * 3_000_000)[:50_000_000]
    n, counts = nra.count_terms(text, frozenset([b"beta"]))
    assert n == len(text.split()) and counts == {b"beta": text.count(b"Beta")}


def test_reads_stop_early_and_intervals_close():
    """With one strong document the lists of frequent terms are not read to their ends."""
    n = 20_000
    impacts = np.sort(np.random.default_rng(1).integers(1, 1000, n))[::-1]
    docs = np.arange(n, dtype=np.int32)
    shard = nra.shard_of(
        np.repeat(np.array([0, 1], np.int32), n), np.concatenate([docs, docs]), np.concatenate([impacts, impacts]), 2, n
    )
    read = []
    plain = nra.Reader.__post_init__

    class Counting(nra.Reader):
        def __post_init__(self):
            plain(self)
            read.append(self)

    original, nra.Reader = nra.Reader, Counting
    try:
        where, scores = nra.top_of_shard(shard, [0, 1], [5, 7], 10)
    finally:
        nra.Reader = original
    best = np.sort(impacts * 12)[::-1][:10]
    assert sorted(scores.tolist(), reverse=True)[:10] == best.tolist()
    assert all(r.at < n / 10 for r in read)
    assert len(where) < 500
