"""Quality rules whose cutoffs carry a guarantee, in DataFrame functions alone.

A rule rejects a document whose signal lies beyond a cutoff. The cutoffs of all rules form one fixed sequence,
rule after rule, each from lenient to strict: a step adds its cutoff to those before it. On labelled rows each step is
tested: is the chance that any of its rules rejects a good document of this stratum at most ``alpha``? The test is the exact
binomial tail, its level ``delta`` divided by the number of strata (Bonferroni); within a stratum the sequence ends at the first step
that fails and so needs no further correction. With confidence 1 - ``delta`` every stratum loses at most a share ``alpha`` of its
good documents, by all rules together. What is more lenient than the last step passed rejects less, so each rule is free to
take the cutoff up to there that rejects most bad documents against good ones, and none if no cutoff does better than keeping all.
``alpha`` is spent once: at the defaults and four strata, 217 good labels of which none is rejected prove a step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridelake.llm.shared import stored

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Signals and their cutoffs, lenient first. A document is rejected if its signal is larger. The order of the rules is that of
# the sequence: where a stratum's good documents fail one rule, those after it have no cutoff there.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbol_share": ("n_symbols / greatest(word_chars, 1)", (0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01)),
    "long_words": ("word_chars / greatest(n_words, 1)", (15.0, 12.0, 11.0, 10.0, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5, 6.0)),
    "short_words": ("- word_chars / greatest(n_words, 1)", (-1.0, -1.5, -2.0, -2.5, -3.0, -3.5)),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    "repeat_share": ("n_repeat_words / greatest(n_words, 1)", (0.18, 0.15, 0.12, 0.1)),
}
BROADCAST_STRATA = 2000


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of five that occurs twice or more in the text; windows are told apart by 64-bit hashes."""

    def of_hashes(hashes: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            again = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
            places = F.sort_array(F.transform(again, lambda x: x["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            step = lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n"), (i + WINDOW).alias("end"))
            return F.aggregate(places, start, step, lambda a: a["n"])

        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(pairs, of_sorted))

    def of_words(w: Column) -> Column:
        first = F.sequence(F.lit(0), F.size(w) - WINDOW)
        hashes = F.transform(first, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return F.when(F.size(w) < WINDOW, 0).otherwise(let(hashes, of_hashes))

    return let(words, of_words)


def measures(docs: DataFrame, id_col: str, text_col: str, stratum: Column) -> DataFrame:
    """The counts of every document: one pass over the texts, narrow rows out of it."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE, -1), "")

    def lines(x: Column) -> Column:
        return F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))

    with_word = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit("")).alias("stratum"),
        let(words, lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("repeat"))).alias("w"),
        F.length(F.translate(text, SPACES, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        let(with_word, lines).alias("l"),
    )
    return counted.select(
        "doc_id",
        "stratum",
        F.col("w.n").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("l.dup").cast("long").alias("n_dup_lines"),
        F.col("w.repeat").cast("long").alias("n_repeat_words"),
        F.col("l.n").cast("long").alias("n_lines"),
    ).withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial (n, p), summed term by term in logarithms. Where k is no less than n p it is given as 1."""
    odds = F.log(F.lit(p / (1 - p)))
    first = n * F.log(F.lit(1 - p))
    start = F.struct(first.alias("t"), F.exp(first).alias("sum"))

    def step(a: Column, j: Column) -> Column:
        return let(a["t"] + F.log((n - j + 1) / j) + odds, lambda t: F.struct(t.alias("t"), (a["sum"] + F.exp(t)).alias("sum")))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * p, 1.0).otherwise(F.aggregate(steps, start, step, lambda a: a["sum"]))


def cutoffs(labelled: DataFrame, *, alpha: float, delta: float, cost: float) -> DataFrame:
    """``stratum, rule, cutoff`` for the rules that may reject, from ``stratum, good`` and the signals of labelled rows."""
    steps = [(rule, float(c)) for rule, (_, cs) in RULES.items() for c in cs]
    grid = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.expr(RULES[r][0]).cast("double").alias("value")) for i, (r, c) in enumerate(steps)])
    first = let(grid, lambda g: F.array_min(F.transform(F.filter(g, lambda x: x["value"] > x["cutoff"]), lambda x: x["step"])))
    tried = labelled.select("stratum", "good", first.alias("first"), F.explode(grid).alias("g")).select("stratum", "good", "first", "g.*")
    beyond = F.col("value") > F.col("cutoff")
    counted = tried.groupBy("stratum", "rule", "step", "cutoff").agg(
        F.sum(F.col("good").cast("long")).alias("n"),
        F.sum((F.col("good") & beyond).cast("long")).alias("k"),
        F.sum((~F.col("good") & beyond).cast("long")).alias("bad"),
        F.coalesce(F.sum((F.col("good") & (F.col("first") == F.col("step"))).cast("long")), F.lit(0)).alias("new"),
    )
    # A row for each stratum and step: the strata are counted over that small table.
    strata = F.size(F.collect_set("stratum").over(Window.partitionBy("step")))
    order = Window.partitionBy("stratum").orderBy("step")
    tested = counted.withColumn("level", F.lit(delta) / strata).withColumn("rejected", F.sum("new").over(order))
    tested = tested.withColumn("passed", (F.col("n") > 0) & (binomial_tail(F.col("rejected"), F.col("n"), alpha) <= F.col("level")))
    certified = tested.withColumn("certified", F.min("passed").over(order)).where("certified")
    gain = F.col("bad") - cost * F.col("k")
    best = certified.groupBy("stratum", "rule").agg(F.max_by(F.struct("cutoff", gain.alias("gain")), F.struct(gain.alias("gain"), -F.col("step"))).alias("b"))
    return best.where("b.gain > 0").select("stratum", "rule", "b.cutoff")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
    alpha: float = 0.02,
    delta: float = 0.05,
    cost: float = 5.0,
) -> DataFrame:
    """The counts and verdict of every document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rules, kept``.

    ``base_failed`` documents go in any case. Of the others, those go that a rule rejects in their stratum (null is a
    stratum of its own); ``failed_rules`` names the rules, in order. Labels are 0 or 1 by document, of several the smallest,
    others are ignored; a stratum with too few labels to prove a cutoff has none and keeps all. One good
    document lost weighs as ``cost`` bad ones kept. Null and empty texts have no words and fail the base. Rows that share an
    id are judged one by one. No rows give no rows; no labels keep all that pass the base.
    """
    base = stored(measures(docs, id_col, text_col, F.col(stratum_col)), "measures")
    truth = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("doc_id")).agg((F.min(label_col) == 1).alias("good"))
    chosen = stored(cutoffs(base.where("NOT base_failed").join(truth, "doc_id"), alpha=alpha, delta=delta, cost=cost), "cutoffs")
    by_stratum = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    if by_stratum.count() <= BROADCAST_STRATA:
        by_stratum = F.broadcast(by_stratum)
    fails = [F.when(F.expr(e).cast("double") > F.element_at("limits", F.lit(r)), F.lit(r)) for r, (e, _) in RULES.items()]
    failed = F.array_compact(F.array(*fails))
    judged = base.join(by_stratum, "stratum", "left").withColumn("failed_rules", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(failed))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rules",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"),
    )
