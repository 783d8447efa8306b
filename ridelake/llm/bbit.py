"""Near-duplicates by b-bit MinHash: links of Jaccard similarity at or above a threshold, and their groups.

1. Every text becomes the set of its shingles. Equal sets are one node from here on.
2. ``permutations`` minima per node: bands of them give buckets, and the low ``bits`` of each are
   kept, packed. Two nodes' signatures agree by chance in a share ``2^-bits`` of the places, which the
   estimate takes out.
3. Each bucket compares its members with two centres only (its smallest node and the one with the most
   copies): by the estimate, then exactly, on the full sets. The links found make groups, in which
   copies of copies have mostly come together.
4. What is left are buckets that hold several groups. There the packed signatures of all members
   of different groups are compared in blocks, and pairs of groups that may be linked come out, each
   once. These are settled on the full sets of all their members, by counting shared shingles
   block against block.

So no bucket, however large, is written out as pairs or gathered in one task, and no candidate is
dropped: a pair is lost only if none of its bands collide (less than one in 10^5 at the default
threshold) or if the estimate errs by over five standard deviations.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.components import components
from ridelake.llm.shared import batches_of, pieces, stored
from ridelake.llm.words import WordCodes, mixed, window_hashes

ROWS_PER_BAND = 5
# Rows of units for each task of comparing groups.
UNIT_ROWS = 4_000
KNOWN_WORDS = 60_000  # remembered by a worker
BATCH_ROWS = 1_000  # sent to a worker at once: a pair's row holds two full sets
SLICE = 256  # rows with full sets that are open at once
SMALL_PAIR = 16  # groups whose product of sizes is at most this are settled pair by pair

# Low half-byte agreement of two packed bytes, by their exclusive or.
_EQUAL_NIBBLES = np.array([(x >> 4 == 0) + (x & 15 == 0) for x in range(256)], np.uint8)


def shingle_set(codes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, no words are none."""
    if not len(codes):
        return np.empty(0, np.uint64)
    if len(codes) < width:
        return mixed(window_hashes(codes, len(codes)) ^ np.uint64(len(codes)))
    return np.unique(window_hashes(codes, width))


def text_set(words: WordCodes, text: str | None, width: int) -> np.ndarray:
    return shingle_set(words.of((text or "").encode().lower().split()), width)


def multipliers(permutations: int) -> np.ndarray:
    return mixed(np.arange(1, permutations + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def minima(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The smallest hash under each of the multiplicative permutations; long sets in slices."""
    low = np.full(len(by), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(low, (hashes[None, at : at + 2048] * by[:, None]).min(axis=1), out=low)
    return mixed(low)


def packed_bits(minima_: np.ndarray) -> bytes:
    """The low four bits of each minimum, two to a byte."""
    low = (minima_ & np.uint64(15)).astype(np.uint8)
    return (low[0::2] << 4 | low[1::2]).tobytes()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures, row against row, without the collisions that chance gives."""
    agree = _EQUAL_NIBBLES[a ^ b].sum(axis=-1, dtype=np.int32) / (2 * a.shape[-1])
    return (agree - 1 / 16) / (1 - 1 / 16)


def lowest_estimate(threshold: float, permutations: int) -> float:
    """Five standard deviations below the threshold."""
    p = threshold + (1 - threshold) / 16
    return threshold - 5 * sqrt(p * (1 - p) / permutations) / (1 - 1 / 16)


def similar(shared: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """100 * intersection >= percent * union, in whole numbers."""
    return 100 * shared >= percent * (left + right - shared)


# Steps


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("t"), text.alias("text"))


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int) -> DataFrame:
    """``doc, t, n, k1, k2, bits, bands`` of every row; ``t`` tells texts of one id apart, ``k1, k2`` identify the set."""
    by = multipliers(bands * ROWS_PER_BAND)
    schema = "doc long, t long, n long, k1 long, k2 long, bits binary, bands array<long>"

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, number = WordCodes(KNOWN_WORDS), np.arange(bands, dtype=np.uint64)
        for batch in batches:
            rows = []
            for doc, t, text in zip(batch["doc"], batch["t"], batch["text"]):
                hashes = text_set(words, text, width)
                if not len(hashes):
                    rows.append((doc, t, 0, 0, 0, None, None))
                    continue
                key = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64)
                low = minima(hashes, by)
                band = window_hashes(low, ROWS_PER_BAND)[::ROWS_PER_BAND] ^ mixed(number + np.uint64(1))
                rows.append((doc, t, len(hashes), key[0], key[1], packed_bits(low), band.view(np.int64)))
            out = pd.DataFrame(rows, columns=["doc", "t", "n", "k1", "k2", "bits", "bands"])
            yield out.astype({"doc": "Int64"})

    return texts_of(docs, id_col, text_col).mapInPandas(sign, schema)


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``node, hashes``: the whole shingle set of each wanted node, as sorted packed numbers.

    ``wanted`` has ``node, doc, t, rows``: the row that stands for the node, and how many there are of it.
    """

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordCodes(KNOWN_WORDS)
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                batch = whole.iloc[at : at + SLICE]
                packed = [text_set(words, t, width).tobytes() for t in batch["text"]]
                yield pd.DataFrame({"node": batch["node"], "hashes": packed})

    texts = texts_of(docs, id_col, text_col)
    if not wanted.where("rows > 1").isEmpty():
        texts = texts.dropDuplicates(["doc", "t"])
    texts = texts.join(wanted, ["doc", "t"]).select("node", "text")
    return stored(texts.mapInPandas(sets, "node long, hashes binary"), "shingle-sets")


def linked(rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a, b``) whose full sets, ``left`` and ``right``, are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # A row holds two full sets: few are unpacked at a time.
            for at in range(0, whole.num_rows, SLICE):
                batch, keep = whole.slice(at, SLICE), []
                for a, b in zip(batch.column("left"), batch.column("right")):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                    alike = min(len(x), len(y)) * 100 >= percent * max(len(x), len(y))
                    shared = len(np.intersect1d(x, y, assume_unique=True)) if alike else 0
                    keep.append(bool(similar(shared, len(x), len(y), percent)))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("a", "b", "left", "right").mapInArrow(check, "a long, b long")


def with_sets(pairs: DataFrame, sets: DataFrame, one: str, other: str) -> DataFrame:
    left = sets.select(F.col("node").alias(one), F.col("hashes").alias("left"))
    right = sets.select(F.col("node").alias(other), F.col("hashes").alias("right"))
    return pairs.join(left, one).join(right, other)


def centre_pairs(members: DataFrame) -> DataFrame:
    """``a, b``: members with their buckets' centres, where the estimate admits a link."""
    centres = members.groupBy("bucket").agg(F.min("node").alias("c1"), F.max_by("node", F.struct("copies", -F.col("node"))).alias("c2"), F.count("*").alias("m")).where("m > 1")
    centre = F.explode(F.array_distinct(F.array("c1", "c2"))).alias("b")
    return members.join(centres, "bucket").select(F.col("node").alias("a"), centre).where("a <> b").distinct()


def estimated(pairs: DataFrame, nodes: DataFrame, low: float) -> DataFrame:
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a, b = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), -1) for c in ("left", "right"))
                yield batch.loc[estimate(a, b) >= low, ["a", "b"]]

    one = nodes.select(F.col("node").alias("a"), F.col("bits").alias("left"))
    other = nodes.select(F.col("node").alias("b"), F.col("bits").alias("right"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "left", "right").mapInPandas(check, "a long, b long")


def group_pairs(members: DataFrame, low: float, block: int) -> DataFrame:
    """``a, b``: pairs of groups with members in one bucket whose estimate admits a link, each once.

    ``members`` has ``bucket, node, bits, grp``. Members of a bucket's largest-id-count group need no
    comparison among themselves: the others are cut into blocks first, and each of their blocks
    meets each block of the bucket once.
    """
    many = members.groupBy("bucket").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"), F.count("*").alias("m")).where("lo <> hi")
    sizes = members.join(many.select("bucket"), "bucket", "left_semi").groupBy("bucket", "grp").count()
    main = sizes.groupBy("bucket").agg(F.max_by("grp", F.struct("count", "grp")).alias("main"), F.sum("count").alias("m"), F.max("count").alias("big"))
    rest = F.ceil((F.col("m") - F.col("big")) / block).cast("int")
    base = F.ceil(F.col("big") / block).cast("int")
    placed = members.join(main, "bucket").withColumns({"rest": rest, "base": base, "own": F.col("grp") == F.col("main")})
    slot = F.when(F.col("own"), F.col("rest") + F.pmod(F.xxhash64("node"), F.col("base"))).otherwise(F.pmod(F.xxhash64("node"), F.col("rest"))).cast("int")
    placed = placed.withColumn("slot", slot)
    everywhere = F.transform(F.sequence(F.lit(0), F.col("rest") - 1), lambda i: F.struct(F.least(i, F.col("slot")).alias("i"), F.greatest(i, F.col("slot")).alias("j")))
    row = F.transform(F.sequence(F.lit(0), F.col("rest") + F.col("base") - 1), lambda i: F.struct(F.least(i, F.col("slot")).alias("i"), F.greatest(i, F.col("slot")).alias("j")))
    units = placed.withColumn("unit", F.explode(F.array_distinct(F.when(F.col("own"), everywhere).otherwise(row))))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = rows["i"].iloc[0], rows["j"].iloc[0]
        left, right = rows[rows["slot"] == i], rows[rows["slot"] == j]
        bits = [np.frombuffer(b"".join(x["bits"]), np.uint8).reshape(len(x), -1) for x in (left, right)]
        groups, found = [x["grp"].to_numpy() for x in (left, right)], []
        for k in range(len(left)):
            near = groups[1][(estimate(bits[1], bits[0][k]) >= low) & (groups[1] != groups[0][k])]
            found += [(min(groups[0][k], x), max(groups[0][k], x)) for x in np.unique(near)]
        return pd.DataFrame(sorted(set(found)), columns=["a", "b"]).astype("int64")

    # Comparing costs more than the rows weigh: tasks are made by the number of rows in units, which splits no unit.
    rows_in_units = placed.agg(F.sum(F.col("rest") + F.when(F.col("own"), 0).otherwise(F.col("base"))).cast("long").alias("n")).first().n
    keyed = units.select("bucket", F.col("unit.i").alias("i"), F.col("unit.j").alias("j"), "slot", "grp", "bits")
    keyed = keyed.repartition(pieces(rows_in_units or 0, UNIT_ROWS), "bucket", "i", "j")
    return keyed.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def settled_pairs(pairs: DataFrame, groups: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """``a, b``: the pairs of groups with a similar pair of members, decided on the full sets.

    The larger group of a pair lies in blocks; members of smaller groups are dealt to each of its blocks,
    in parts, and every block counts shared shingles by an inverted list.
    """
    size = groups.groupBy("grp").agg(F.count("*").alias("size"))
    sized = pairs.join(size.select(F.col("grp").alias("a"), F.col("size").alias("sa")), "a").join(size.select(F.col("grp").alias("b"), F.col("size").alias("sb")), "b")
    big = F.col("sa") >= F.col("sb")
    sized = sized.select(F.when(big, F.col("a")).otherwise(F.col("b")).alias("base"), F.when(big, F.col("b")).otherwise(F.col("a")).alias("probe"), F.greatest("sa", "sb").alias("nb"), F.least("sa", "sb").alias("np"))
    sized = stored(sized, "group-pairs")
    small, large = sized.where(F.col("nb") * F.col("np") <= SMALL_PAIR), sized.where(F.col("nb") * F.col("np") > SMALL_PAIR)

    node_of = lambda name, node: groups.select(F.col("grp").alias(name), F.col("node").alias(node))
    few = small.join(node_of("base", "x"), "base").join(node_of("probe", "y"), "probe")
    few = with_sets(few, sets, "x", "y").select(F.col("base").alias("a"), F.col("probe").alias("b"), "left", "right")

    bases = large.select("base", "nb").distinct()
    blocks = F.greatest(F.lit(1), F.ceil(F.col("nb") / block)).cast("int")
    held = bases.join(node_of("base", "node"), "base").withColumn("part", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    held = held.join(sets, "node").select(F.col("base").alias("base1"), F.col("part").alias("part1"), F.col("hashes").alias("held"))
    asked = large.join(node_of("probe", "node"), "probe").withColumn("part", F.explode(F.sequence(F.lit(0), blocks - 1)))
    asked = asked.join(sets, "node").select(F.col("base").alias("base2"), F.col("part").alias("part2"), F.col("probe").alias("asker"), F.col("hashes").alias("asked"))

    def count(base: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        if not len(base) or not len(probes):
            return pd.DataFrame(columns=["a", "b"]).astype("int64")
        own = [np.frombuffer(x, np.uint64) for x in base["held"]]
        lengths = np.array([len(x) for x in own])
        every, owner = np.concatenate(own), np.repeat(np.arange(len(own)), lengths)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        found = set()
        for probe, packed in zip(probes["asker"], probes["asked"]):
            x = np.frombuffer(packed, np.uint64)
            lo, hi = np.searchsorted(every, x, "left"), np.searchsorted(every, x, "right")
            runs = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
            shared = np.bincount(owner[at], minlength=len(own))
            if similar(shared, lengths, len(x), percent).any():
                found.add(probe)
        return pd.DataFrame({"a": int(base["base1"].iloc[0]), "b": sorted(found)}, columns=["a", "b"]).astype("int64")

    many = held.groupBy("base1", "part1").cogroup(asked.groupBy("base2", "part2")).applyInPandas(count, "a long, b long")
    return linked(few, percent).union(many).distinct()


def grouped_sets(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, bands: int, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, the distinct sets as nodes, and ``node, component`` of the linked ones."""
    low = lowest_estimate(percent / 100, bands * ROWS_PER_BAND)
    signed = stored(signatures(docs, id_col, text_col, width, bands), "signatures")
    whole = signed.where("n > 0 AND doc IS NOT NULL")
    # Numbered in the order of their smallest documents: a group's smallest node has its smallest document.
    distinct = whole.groupBy("k1", "k2").agg(F.min(F.struct("doc", "t")).alias("own"), F.count("*").alias("copies")).orderBy("own", "k1", "k2")
    sets_of = stored(distinct.select("k1", "k2", "own.doc", "own.t", "copies", F.monotonically_increasing_id().alias("node")), "distinct-sets")
    # One signature for each set, from the row that stands for it.
    one = whole.select("doc", "t", "k1", "k2", "bits", "bands").join(sets_of, ["doc", "t", "k1", "k2"])
    one = one.groupBy("doc", "t", "k1", "k2", "node", "copies").agg(F.first("bits").alias("bits"), F.first("bands").alias("bands"), F.count("*").alias("rows"))
    nodes = stored(one.select("node", "doc", "t", "rows", "copies", "bits", "bands"), "nodes")

    buckets = nodes.select("node", "copies", F.explode("bands").alias("bucket"))
    several = buckets.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket")
    members = stored(buckets.join(several, "bucket"), "buckets")
    candidates = stored(estimated(centre_pairs(members), nodes, low), "candidates")
    involved = members.select("node").distinct()
    wanted = nodes.join(involved, "node", "left_semi").select("node", "doc", "t", "rows")
    sets = full_sets(docs, wanted, id_col, text_col, width)

    links = stored(linked(with_sets(candidates, sets, "a", "b"), percent), "links")
    first = components(links)
    grouped = nodes.join(involved, "node", "left_semi").join(first, "node", "left")
    grouped = stored(grouped.select("node", "bits", F.coalesce("component", "node").alias("grp")), "groups")
    open_ = stored(group_pairs(members.select("bucket", "node").join(grouped, "node"), low, block), "open-pairs")
    more = settled_pairs(open_, grouped.select("node", "grp"), sets, percent, block)
    # A group's number is one of its nodes, so links between groups are links between nodes.
    last = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    return signed, sets_of, last


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = 32,
    block: int = 1024,
) -> DataFrame:
    """Groups of near-duplicates: ``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are as in ``words.py`` with A-Z lower-cased; a document's set are its distinct shingles of
    ``width`` words, or its whole sequence if it is shorter. Documents are linked if 100 * intersection
    >= ``percent`` * union; ``component_id`` is the smallest id reachable by links, ``kept`` whether it is
    the document's own. Null and wordless texts have 0 shingles and are linked with nothing.
    Rows with equal texts are linked like any others; rows that repeat an id are judged row by row,
    each by its own text, so one id with two texts may stand in two groups.
    A null id takes no part: its component is null and the row is kept. No rows give no rows.
    """
    with batches_of(docs.sparkSession, BATCH_ROWS):
        signed, sets_of, last = grouped_sets(docs, id_col, text_col, width, percent, bands, block)
    smallest = last.join(sets_of.select(F.col("node").alias("component"), F.col("doc").alias("smallest")), "component").select("node", "smallest")
    named = sets_of.join(smallest, "node", "left").select("k1", "k2", F.coalesce("smallest", "doc").alias("component"))
    own = signed.join(named, ["k1", "k2"], "left")
    component = F.when(F.col("doc").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component"))
    return own.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
