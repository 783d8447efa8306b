"""Packing of documents into sequences by minimum bin slack.

Documents are cut into full sequences and a rest. The rests of a corpus are at most ``length`` different lengths with
counts, whatever its size, and the plan is made on those: a window takes the longest remaining length, then the
multiset of remaining lengths that fills it closest to capacity. Sums that can be reached are the
bits of one whole number, to which each length is added by shifts; walking back through them gives
the counts. A filling is repeated as long as the counts last.

Pieces find their window by their rank among pieces of their length. Ranks are counted in hashed cells, so a
length that many documents share is ranked by many tasks.

``pack`` treats documents as a set. ``pack_in_order`` keeps the order they are laid out in: spans of consecutive rows
are planned each by itself, and the sequences of a span follow those of the span before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridelake.llm.shared import pieces, stored
from ridelake.llm.tokens import encoder

PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary, ids_crc32 long"


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``capacity``: how often to take each."""
    mask = (1 << capacity + 1) - 1
    reach, steps = 1, []
    for size in sorted(counts, reverse=True):
        left, times = min(counts[size], capacity // size), 1
        while left > 0 and not reach >> capacity & 1:
            take = min(times, left)
            steps.append((size, take, reach))
            reach |= reach << size * take & mask
            left, times = left - take, times * 2
        if reach >> capacity & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for size, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[size] = chosen.get(size, 0) + take
            at -= size * take
    return chosen


def plan(counts: dict[int, int], length: int) -> dict[int, np.ndarray]:
    """For every length, rows of (first rank, pieces in a sequence, first sequence, offset), by rank."""
    left, sequence = {k: v for k, v in counts.items() if v > 0}, 0
    used = dict.fromkeys(left, 0)
    rows: dict[int, list[tuple]] = {k: [] for k in left}
    while left:
        longest = max(left)
        rest = {k: v - (k == longest) for k, v in left.items()}
        chosen = fullest({k: v for k, v in rest.items() if v}, length - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times, offset = min(left[k] // n for k, n in chosen.items()), 0
        for k in sorted(chosen, reverse=True):
            n = chosen[k]
            rows[k].append((used[k], n, sequence, offset))
            used[k] += n * times
            left[k] -= n * times
            offset += n * k
            if not left[k]:
                del left[k]
        sequence += times
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def place(table: np.ndarray, size: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces of one length with the given ranks."""
    row = table[np.searchsorted(table[:, 0], ranks, "right") - 1]
    past = ranks - row[:, 0]
    return row[:, 2] + past // row[:, 1], row[:, 3] + past % row[:, 1] * size


def sequences_planned(tables: dict[int, np.ndarray], counts: dict[int, int]) -> int:
    """How many sequences a plan of these counts fills."""
    most = 0
    for size, table in tables.items():
        pieces_ = np.diff(np.append(table[:, 0], counts[size]))
        most = max(most, int((table[:, 2] + (pieces_ - 1) // table[:, 1]).max()) + 1)
    return most


def token_pieces(docs: DataFrame, *, id_col: str, text_col: str, path: str, keeps_space: bool, end_id: int, length: int, at_col: str | None = None) -> DataFrame:
    """The pieces of every document: full sequences and a rest, the end id included; with ``at_col``, its number as ``_at``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path, keeps_space)
        for batch in batches:
            rows = []
            for found, doc, *own in zip(encode.encode_all(batch["text"]), *[batch[c] for c in read]):
                ids = np.append(found, np.array([end_id], encode.dtype))
                for at in range(0, len(ids), length):
                    part = ids[at : at + length]
                    rows.append((doc, at, len(part), len(ids), part.tobytes(), zlib.crc32(part.astype("<u4").tobytes()), *own))
                if len(rows) >= 4096:
                    yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
                    rows = []
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    schema = PIECES + (", _at long" if at_col else "")
    columns = [x.split()[0] for x in schema.split(", ")]
    picked = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    picked += [F.col(at_col).cast("long").alias("_at")] if at_col else []
    read = ["doc_id"] + ["_at"] * bool(at_col)
    return docs.select(*picked).mapInPandas(cut, schema)


def pack(
    docs: DataFrame,
    *,
    path: str,
    keeps_space: bool = True,
    end_id: int = 0,
    length: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    cell_rows: int = 50_000,
) -> DataFrame:
    """Every piece with its place: ``doc_id, start, length, doc_tokens, ids, ids_crc32, sequence_id, offset``.

    Each id of each document, and the end id behind it, lies in exactly one piece; ``ids`` are little-endian
    numbers, of 16 bits where the vocabulary fits in them and else of 32; ``ids_crc32`` is of 32-bit ones always. Sequences are numbered from 0 without gaps, pieces in one follow each other from
    offset 0. A null or empty text is the end id alone. Rows that share an id, or have none, are pieces
    of their own. No rows give no rows. Other columns are not read.
    """
    cut = stored(token_pieces(docs, id_col=id_col, text_col=text_col, path=path, keeps_space=keeps_space, end_id=end_id, length=length), "pieces")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    tables = plan(counts, length)
    cells = pieces(sum(counts.values()), cell_rows)
    celled = cut.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "start"), F.lit(cells)).cast("int"))
    sizes = celled.groupBy("length", "_cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    order = Window.partitionBy("length", "_cell").orderBy("doc_id", "start", "ids_crc32")
    ranked = celled.withColumn("_rank", F.row_number().over(order) - 1).join(offsets, ["length", "_cell"])

    @F.pandas_udf("sequence_id long, offset long")
    def find(sizes_: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        size, rank = sizes_.to_numpy(), ranks.to_numpy()
        out = np.empty((len(size), 2), np.int64)
        for k in np.unique(size):
            own = size == k
            out[own, 0], out[own, 1] = place(tables[int(k)], int(k), rank[own])
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    found = ranked.withColumn("_at", find("length", (F.col("_rank") + F.col("_base")).cast("long")))
    return found.select("doc_id", "start", "length", "doc_tokens", "ids", "ids_crc32", "_at.sequence_id", "_at.offset")


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the number ``name`` of every row from 0, in the order of its files and of the rows in them.

    Rows that do not come straight from Parquet files are written first. Files follow the part number in their names.
    """
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return numbered(stored(docs, "laid-out"), name)
    part = F.regexp_extract("_file", r"/part-(\d+)[^/]*$", 1).try_cast("long")
    # A row for each file.
    before = Window.orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    offsets = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return placed.join(offsets, "_file").withColumn(name, F.col("_base") + F.col("_row")).drop("_file", "_row", "_base")


def pack_in_order(
    docs: DataFrame,
    *,
    path: str,
    keeps_space: bool = True,
    end_id: int = 0,
    length: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    span_rows: int = 4_000,
) -> DataFrame:
    """``pack``, with sequences in the order that the rows of ``docs`` are laid out in.

    Each ``span_rows`` consecutive rows fill sequences of their own, numbered after those of the rows before them, so
    whatever shares of sources the rows have along the way, the sequences have too. Within a span, pieces of one length
    are used in the order of the rows. The last sequences of each span hold its slack.
    """
    # Whatever other columns there are, and are called, goes no further.
    rows = numbered(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), "_at")
    cut = token_pieces(rows, id_col="doc_id", text_col="text", path=path, keeps_space=keeps_space, end_id=end_id, length=length, at_col="_at")
    cut = stored(cut.withColumn("_span", F.floor(F.col("_at") / span_rows).cast("long")), "pieces")

    def plan_span(rows_: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(rows_["length"].tolist(), rows_["n"].tolist()))
        tables = plan(counts, length)
        steps = [[dict(zip(("first", "times", "sequence", "offset"), r)) for r in tables[k].tolist()] for k in tables]
        return pd.DataFrame({"_span": rows_["_span"].iloc[0], "length": list(tables), "_steps": steps, "_filled": sequences_planned(tables, counts)})

    steps = "_span long, length int, _steps array<struct<first:long,times:long,sequence:long,offset:long>>, _filled long"
    planned = stored(cut.groupBy("_span", "length").agg(F.count("*").alias("n")).groupBy("_span").applyInPandas(plan_span, steps), "spans")
    # A row for each span.
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    filled = planned.groupBy("_span").agg(F.max("_filled").alias("_filled"))
    bases = filled.select("_span", F.coalesce(F.sum("_filled").over(before), F.lit(0)).alias("_base"))
    tables = planned.select("_span", "length", "_steps").join(bases, "_span")

    order = Window.partitionBy("_span", "length").orderBy("_at", "start")
    ranked = cut.withColumn("_rank", (F.row_number().over(order) - 1).cast("long")).join(tables, ["_span", "length"])
    found = ranked.withColumn("_step", F.element_at(F.filter("_steps", lambda s: s["first"] <= F.col("_rank")), -1))
    past = F.col("_rank") - F.col("_step.first")
    sequence = F.col("_base") + F.col("_step.sequence") + F.floor(past / F.col("_step.times")).cast("long")
    offset = F.col("_step.offset") + F.pmod(past, F.col("_step.times")) * F.col("length")
    return found.select("doc_id", "start", "length", "doc_tokens", "ids", "ids_crc32", sequence.alias("sequence_id"), offset.alias("offset"))


def padded_length(used: int, length: int = 1024) -> int:
    """Sequences are padded to ``length`` unless what they hold is a power of two long."""
    return used if used & used - 1 == 0 else length


def sequences(packed: DataFrame, *, length: int = 1024, pad_id: int = 0) -> DataFrame:
    """``sequence_id, used, ids`` (array): the packed pieces put together and padded. A sequence is at most ``length`` ids."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("offset")
        data = b"".join(rows["ids"])
        ids = np.frombuffer(data, f"<u{len(data) // rows['length'].sum()}").astype(np.int64)
        whole = np.full(padded_length(len(ids), length), pad_id, np.int64)
        whole[: len(ids)] = ids
        return pd.DataFrame({"sequence_id": rows["sequence_id"].iloc[:1], "used": len(ids), "ids": [whole]})

    return packed.select("sequence_id", "offset", "length", "ids").groupBy("sequence_id").applyInPandas(join, "sequence_id long, used int, ids array<long>")
