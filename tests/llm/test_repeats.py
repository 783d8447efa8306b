from __future__ import annotations

from collections import Counter

from shapes import documents, hard_rows, words

from ridelake.llm import anchors


def brute(rows, window):
    lists = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    low = {}
    for i, own in lists:
        if i is not None:
            for at in range(len(own) - window + 1):
                key = tuple(own[at : at + window])
                low[key] = min(i, low.get(key, i))
    out = Counter()
    for i, own in lists:
        gone = [False] * len(own)
        if i is not None:
            for at in range(len(own) - window + 1):
                if low[tuple(own[at : at + window])] < i:
                    gone[at : at + window] = [True] * window
        out[i, len(own), sum(gone), b" ".join(w for w, x in zip(own, gone) if not x).decode()] += 1
    return out


def check(spark, rows, window=50, **options):
    found = anchors.remove_repeats(documents(spark, rows), window=window, **options).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == brute(rows, window)
    for r in found:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_hard_rows(spark):
    check(spark, hard_rows(), cell_bytes=20_000, bucket_bytes=20_000)
    check(spark, hard_rows())


def test_passages_at_every_offset(spark):
    passage = words(9, 75)
    rows = [(i, " ".join(words(100 + i, i * 7 % 60) + passage[i % 20 :] + words(200 + i, 30)), "en", "a") for i in range(40)]
    check(spark, rows, cell_bytes=3000, bucket_bytes=5000)


def test_ids_far_apart(spark):
    """One id far away, and ids over the whole range of a long: results are whole and no cell holds most of the rows."""
    passage = words(9, 75)
    text = [" ".join(words(300 + i, 40) + passage[i % 20 :]) for i in range(40)]
    near = [(i, t, "en", "a") for i, t in enumerate(text[:38])]
    for far in ([(2**62, text[38], "en", "a")], [(-(2**63), text[38], "en", "a"), (2**63 - 1, text[39], "en", "a")]):
        check(spark, near + far, cell_bytes=3000, bucket_bytes=5000)
        assert largest_cell(spark, near + far, 3000) <= 3000 + 800


def test_cells_hold_bounded_bytes(spark):
    """Long texts with neighbouring ids, and many rows that share one id."""
    long = [(i, " ".join(words(i, 200 if i < 20 else 3)), "en", "a") for i in range(400)]
    assert largest_cell(spark, long, 3000) <= 3000 + 1600
    shared = [(7, " ".join(words(i, 100)), "en", "a") for i in range(60)] + long[300:]
    assert largest_cell(spark, shared, 5000) <= 3 * 5000
    check(spark, shared, cell_bytes=3000, bucket_bytes=5000)


def largest_cell(spark, rows, cell_bytes):
    df = documents(spark, rows).select("doc_id", "text")
    size = sum(len(t) for _, t, *_ in rows)
    cells = anchors.in_cells(df, *anchors.cell_starts(df, size // cell_bytes, cell_bytes))
    held = Counter()
    for r in cells.collect():
        held[r.cell] += len(r.text)
    return max(held.values())


def test_short_odd_windows(spark):
    rows = [(i, " ".join(words(i, 60, 4)), "en", "a") for i in range(30)]
    for window in (2, 3, 7):
        check(spark, rows, window=window, cell_bytes=800, bucket_bytes=800)


def test_no_rows(spark):
    assert anchors.remove_repeats(documents(spark, [])).count() == 0
    check(spark, [(1, None, None, None)])


def test_registered_query(spark):
    import hashlib

    from ridelake.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op2_block_anchors"](spark, folder).collect())
    assert got == Counter({(i, n, k, hashlib.sha256(t.encode()).hexdigest()): c for (i, n, k, t), c in brute(rows, 50).items()})
