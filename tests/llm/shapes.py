"""Rows that operators have to survive: nulls, empty and very long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

CLASHING = "rank int, score string, length string, cell int, bucket int, kept string, component string, n long, k1 long, slot string, held_out int, v string, node int, type string"
N_CLASHING = len(CLASHING.split(", "))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING


def documents(spark, rows):
    """A table of (doc_id, text, lang, source); the clashing columns are null."""
    full = [(*r, len(r[1]) if r[1] is not None else None, *[None] * N_CLASHING) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(seed: int, n: int, vocabulary: int = 500) -> list[str]:
    random_ = random.Random(seed)
    return [f"w{random_.randrange(vocabulary)}" for _ in range(n)]


def hard_rows():
    """About forty rows: each awkward case, with a few ordinary ones."""
    long = " ".join(words(1, 20_000, 50_000))
    base = words(2, 200)
    near = base[:]
    near[100] = "changed"
    rows = [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n", "en", "a"),
        (4, long, "en", "a"),
        (5, " ".join(base), "en", None),
        (6, " ".join(near), "de", "b"),
        (7, "\n".join(base), None, "b"),
        (8, "one two", "en", "c"),
        (9, "One  two", "en", "c"),
        (9, "One  two", "en", "c"),
        (10, "same " * 300, "en", "a"),
        (11, "same " * 300, "en", "a"),
        (-5, " ".join(base[:120]), "en", "a"),
        (None, " ".join(base), "en", "a"),
        (None, None, None, None),
        (12, "!!! ### 123", "en", "d"),
        (13, "naïve café 日本語 текст", "fr", "d"),
        (2**62, " ".join(words(3, 90)), "en", "a"),
    ]
    rows += [(100 + i, " ".join(words(50 + i, 80 + i)), "en" if i % 2 else "fr", "abc"[i % 3]) for i in range(20)]
    return rows
