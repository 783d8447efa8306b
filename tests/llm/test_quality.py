from __future__ import annotations

import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F
from shapes import documents, hard_rows, words

from ridelake.llm import quality


def brute(text):
    text = text or ""
    own = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    again = {j for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(own) < 10 or 100 * len(again) > 20 * len(own)
    chars = sum(len(w.decode()) for w in own)
    return (len(own), chars, len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed)


def labels(spark, rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], "doc_id long, quality int, toxic int, lang string")


def test_counts(spark):
    rows = hard_rows() + [
        (200, "a\nb\na\n\n \na ", "en", "a"),
        (201, "x\x0by\x0cz\r\nx y | & * 5%", "en", "a"),
        (202, " ".join(["p q r s t u"] * 2 + words(1, 100)), "en", "a"),
        (203, " ".join(words(4, 300, 3)), "en", "a"),
    ]
    out = quality.judge(documents(spark, rows), labels(spark, [])).collect()
    want = Counter((i, *brute(t)) for i, t, *_ in rows)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    assert got == want
    assert all(r.kept != r.base_failed and r.failed_rules == [] for r in out)


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (2, 500, 0.02), (7, 1000, 0.01), (0, 3000, 0.004), (5, 20, 0.2)])
def test_binomial_tail(spark, k, n, p):
    want = sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)) if k < n * p else 1.0
    row = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("t")).first()
    assert row.t == pytest.approx(want, rel=1e-9)


def test_cutoffs_reject_bad_and_spare_good(spark):
    good = [(i, " ".join(words(i, 40)), "en", "a") for i in range(1500)]
    bad = [(10_000 + i, " ".join(w + "###" for w in words(i, 40)), "en", "a") for i in range(300)]
    few = [(20_000 + i, " ".join(w + "###" for w in words(i, 40)), "xx", "a") for i in range(5)]
    given = labels(spark, [(i, 1) for i, *_ in good] + [(i, 0) for i, *_ in bad + few] + [(1, None), (2, 7), (10_000, 1)])
    out = {r.doc_id: r for r in quality.judge(documents(spark, good + bad + few), given).collect()}
    assert all(out[i].kept for i, *_ in good)
    assert not any(out[i].kept for i, *_ in bad) and out[10_001].failed_rules[0] == "symbol_share"
    assert all(out[i].kept for i, *_ in few)  # too few labels there to prove anything


def test_cutoff_is_the_certified_one(spark):
    """Against the same procedure in plain Python."""
    rows = [(i, " ".join(words(i, 50) + [f"#{i}{k}" for k in range(i % 50)]), "en", "a") for i in range(2000)]
    truth = {i: int(i % 50 < 30 or i % 400 == 49) for i, *_ in rows}
    alpha, delta, cost = 0.2, 0.05, 5.0
    base = quality.measures(documents(spark, rows), "doc_id", "text", F.col("lang"))
    marked = base.join(labels(spark, truth.items()).select("doc_id", (F.col("quality") == 1).alias("good")), "doc_id").where("NOT base_failed")
    got = {r.rule: r.cutoff for r in quality.cutoffs(marked, alpha=alpha, delta=delta, cost=cost).collect()}
    signals = []
    for i, t, *_ in rows:
        n, chars, symbols, dup, again, failed = brute(t)
        if not failed:
            lines = sum(bool(x.split()) for x in t.split("\n"))
            own = (symbols / chars, chars / n, -chars / n, dup / lines, again / n)
            signals.append((truth[i], dict(zip(quality.RULES, own))))
    n, gains, rejected = sum(g for g, _ in signals), {}, set()
    for rule, (_, cutoffs) in quality.RULES.items():
        for c in cutoffs:
            beyond = [k for k, (_, x) in enumerate(signals) if x[rule] > c]
            rejected |= {k for k in beyond if signals[k][0]}
            k = len(rejected)
            tail = sum(comb(n, j) * alpha**j * (1 - alpha) ** (n - j) for j in range(k + 1)) if k < n * alpha else 1.0
            if tail > delta:
                break
            gains[rule, c] = sum(-cost if signals[j][0] else 1 for j in beyond)
        else:
            continue
        break
    want = {}
    for (rule, c), gain in gains.items():
        if gain > 0 and gain > want.get(rule, (0, 0))[0]:
            want[rule] = (gain, c)
    assert "symbol_share" in want and got == {rule: c for rule, (_, c) in want.items()}


def test_alpha_is_spent_once(spark):
    """Three strata of 230 good labels each are enough for all rules that reject none of them."""
    rows = [(k * 1000 + i, " ".join(w + "#" * (i >= 230) for w in words(k * 1000 + i, 40)), "abc"[k], "s") for k in range(3) for i in range(250)]
    out = quality.judge(documents(spark, rows), labels(spark, [(i, int(i % 1000 < 230)) for i, *_ in rows])).collect()
    assert {r.doc_id for r in out if not r.kept} == {i for i, *_ in rows if i % 1000 >= 230}


@pytest.mark.parametrize("seed", [1, 2])
def test_combined_rejection_is_tested(spark, seed):
    """Two rules that each reject 1.2 % of the good documents, others by each, are too much together."""
    rows = []
    for i in range(3000):
        own = words(seed * 10_000 + i, 60, 20_000)
        if i % 1000 < 12:
            own = [w + "##" for w in own]
        elif i % 1000 < 24:
            own = [w * 4 for w in own]
        rows.append((i, " ".join(own), "en", "s"))
    bad = [(5000 + i, " ".join(w * 4 + "##" for w in words(i, 60, 20_000)), "en", "s") for i in range(200)]
    given = labels(spark, [(i, 1) for i, *_ in rows] + [(i, 0) for i, *_ in bad])
    out = {r.doc_id: r.failed_rules for r in quality.judge(documents(spark, rows + bad), given).collect()}
    assert out[5000] == ["symbol_share"] and out[0] == ["symbol_share"] and out[12] == []


def test_no_rows(spark):
    assert quality.judge(documents(spark, []), labels(spark, [])).count() == 0


def test_plan_is_native(spark):
    out = quality.judge(documents(spark, hard_rows()), labels(spark, [(4, 1)]))
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())


def test_registered_query(spark):
    from ridelake.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op5_risk_controlled_rules"](spark, folder).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
