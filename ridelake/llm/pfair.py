"""Mixing of sources to target weights by Pfair scheduling, in DataFrame functions alone.

Time runs in slots; a slot takes one block of one source. With ``q`` of the ``L`` slots of a cycle due to a source,
its block ``i`` (from 0) is released at slot ``floor(i L / q)`` and due by slot ``ceil((i + 1) L / q)``, and the
scheduler takes, of the released blocks, the one that is due first. The weights fill the
time exactly, so every block runs inside its window, and after any number of slots each source has
had its weighted share to within less than one block.

The schedule of one cycle depends on the weights only. Documents find their slot in it by their rank
in a hashed order of their source; ranks are counted in chunks, so a source with a third of all rows is ranked by
many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridelake.llm.shared import pieces

ADDED = ("block", "slot", "place")
BROADCAST_SOURCES = 2000


def source_key(source_col: str) -> Column:
    """A text that names the source and is never null: null is a source of its own."""
    name = F.col(source_col).cast("string")
    return F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name))


def quotas(docs: DataFrame, source_col: str, weights: dict[str, float] | None, exponent: float, cycle: int) -> DataFrame:
    """``key, source, n, q``: rows of each source and the slots of a cycle that are due to it.

    Slots follow ``weights``, or the power ``exponent`` of the source's size; every source has one at least.
    """
    counted = docs.groupBy(source_key(source_col).alias("key"), F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow("n", F.lit(float(exponent)))
    else:
        given = [F.when(F.col("source") == k, F.lit(float(w))) for k, w in weights.items() if w > 0]
        weight = F.coalesce(*given, F.lit(0.0)) if given else F.lit(0.0)
    total = F.sum("w").over(Window.partitionBy())
    share = F.when(total > 0, F.col("w") / total).otherwise(0.0)
    return counted.withColumn("w", weight).withColumn("q", F.greatest(F.lit(1), F.round(share * cycle).cast("int"))).drop("w")


def _pick(counts: Column, quota: Column, slots: Column, t: Column) -> Column:
    """The index of the source whose released block is due first; of equals, the first source."""

    def due(i: Column) -> Column:
        done, q = F.get(counts, i).cast("long"), F.get(quota, i).cast("long")
        release = F.floor(done * slots / q)
        deadline = F.ceil((done + 1) * slots / q)
        return F.when((done < q) & (release <= t), F.struct(deadline.alias("due"), i.alias("i")))

    return F.array_min(F.transform(F.sequence(F.lit(0), F.size(quota) - 1), due))["i"]


def schedule(quota: DataFrame) -> DataFrame:
    """``key, k, t, slots``: the slot ``t`` of the ``k``-th block that a source has in a cycle.

    As many rows as a cycle has slots: the parameter ``cycle`` and one for each source at most.
    """
    table = quota.agg(F.sort_array(F.collect_list(F.struct("key", "q"))).alias("sources"))
    table = table.where(F.size("sources") > 0).withColumn("quota", F.transform("sources", lambda x: x["q"]))
    table = table.withColumn("slots", F.aggregate("quota", F.lit(0).cast("long"), lambda a, q: a + q))
    start = F.struct(F.transform("quota", lambda _: F.lit(0)).alias("counts"), F.array().cast("array<int>").alias("picks"))

    def step(state: Column, t: Column) -> Column:
        # The pick is bound to a name by the one-element array it stands in.
        i = F.array(_pick(state["counts"], F.col("quota"), F.col("slots"), t))
        return F.element_at(
            F.transform(
                i,
                lambda p: F.struct(
                    F.transform(state["counts"], lambda c, j: c + (j == p).cast("int")).alias("counts"),
                    F.array_append(state["picks"], p).alias("picks"),
                ),
            ),
            1,
        )

    run = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1), start, step, lambda s: s["picks"])
    picked = table.select("sources", "slots", run.alias("picks")).select("sources", "slots", F.posexplode("picks").alias("t", "i"))
    own = picked.select(F.get("sources", F.col("i"))["key"].alias("key"), "slots", "t")
    turn = Window.partitionBy("key").orderBy("t")
    return own.select("key", (F.row_number().over(turn) - 1).alias("k"), "t", "slots")


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: dict[str, float] | None = None,
    exponent: float = 0.5,
    cycle: int = 1000,
    block_rows: int = 16,
    chunk_rows: int = 4_000,
    seed: int = 7,
) -> DataFrame:
    """All rows of ``docs`` with their place in the mixture: ``block, slot, place``.

    ``place`` orders the mixture: ``slot`` times the block's rows plus the row's place in its block. No row is left out and
    none repeats; a source that has run out leaves its slots empty and the others go on
    in their proportions. While all sources last, each has had its weighted number of slots to
    within less than one, after any number of slots. Without ``weights`` they are the sources' sizes to
    the power ``exponent``; a source that ``weights`` does not name, or not above zero, gets one slot of a
    cycle, so that its rows stay. Weights are met to half a slot of ``cycle``. A null source is a
    source of its own. Order within a source is by a hash of the id, then the id, nulls first; rows that share an id
    may stand in either order. No rows give no rows. Columns named as the added ones are replaced.
    """
    quota = quotas(docs, source_col, weights, exponent, cycle)
    # A quota and a slot take a few dozen bytes: broadcast where counted to be few, else joined by a shuffle.
    small = F.broadcast if quota.count() <= BROADCAST_SOURCES else (lambda df: df)
    cells = pieces(docs.count(), chunk_rows)
    order = [F.xxhash64(F.lit(seed), F.col(id_col)), F.col(id_col)]
    chunk = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(id_col)), F.lit(cells)).cast("int")

    kept = [c for c in docs.columns if c.lower() not in ADDED]
    key = source_key(source_col)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], key.alias("_pf_key"), chunk.alias("_pf_chunk"))
    sizes = docs.groupBy(key.alias("_pf_key"), chunk.alias("_pf_chunk")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("_pf_key").orderBy("_pf_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pf_key", "_pf_chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_pf_base"))

    within = Window.partitionBy("_pf_key", "_pf_chunk").orderBy(*order)
    ranked = rows.withColumn("_pf_rank", F.row_number().over(within) - 1).join(offsets, ["_pf_key", "_pf_chunk"])
    rank = F.col("_pf_rank") + F.col("_pf_base")
    q = quota.select(F.col("key").alias("_pf_key"), F.col("q").alias("_pf_q"))
    block = F.floor(F.col("_pf_rank") / block_rows).cast("long")
    placed = ranked.withColumn("_pf_rank", rank).join(small(q), "_pf_key").withColumn("block", block)
    placed = placed.withColumn("_pf_k", F.pmod("block", F.col("_pf_q").cast("long")).cast("int"))
    slots = schedule(quota).select(F.col("key").alias("_pf_key"), F.col("k").alias("_pf_k"), F.col("t").alias("_pf_t"), F.col("slots").alias("_pf_l"))
    placed = placed.join(small(slots), ["_pf_key", "_pf_k"])
    slot = F.floor(F.col("block") / F.col("_pf_q")).cast("long") * F.col("_pf_l") + F.col("_pf_t")
    place = F.col("slot") * block_rows + F.pmod("_pf_rank", F.lit(block_rows).cast("long"))
    return placed.withColumn("slot", slot).withColumn("place", place).select(*[F.col(f"`{c}`") for c in kept], *ADDED)


def in_order(mixed: DataFrame) -> DataFrame:
    """The mixture laid out in its order: files, and rows in them, follow ``place``."""
    return mixed.repartitionByRange(F.col("place")).sortWithinPartitions("place")
