"""Removal of repeated passages by fixed-block anchors.

Of two documents that share ``window`` consecutive words, the shared stretch covers a whole aligned block of
``window // 2`` words in either of them. So it is enough to index the non-overlapping blocks of every
document and to probe them with every rolling window of that length:

1. Cells of neighbouring ids, cut by the bytes of their texts, send the hashes of all rolling windows, each once, to buckets, with a mark
   on those that are blocks. A hash that is a block somewhere and occurs in two documents is a hit.
   30 bits of it travel: what agrees by chance costs a comparison later and nothing else.
2. Hits return to their cells. There they are extended to all windows of full length around them,
   whose 144-bit hashes meet in a second exchange; each learns the smallest id that it occurs in.
3. Windows that a smaller id has too make up the maximal exact repeats, and their words go.

Cells pre-aggregate: a passage that a third of all documents share is sent once by each cell, and no step
makes pairs of documents. Documents without hits leave after step 2 and are not moved again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.shared import pieces, stored, text_bytes
from ridelake.llm.words import WordCodes, window_hashes

RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("kept_text", pa.string()),
        ("cell", pa.int64()),
        ("open_text", pa.string()),
    ]
)

_BUCKET_BITS, _HASH_BITS = 24, 30
_WIDE = np.dtype([("h", "<u8"), ("g", "<u2")])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true places, as half-open intervals."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:n]) > 0


def _short(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 30-bit rest of a hash."""
    return ((hashes >> np.uint64(64 - _BUCKET_BITS)) % np.uint64(buckets)).astype(np.int32), (hashes & np.uint64((1 << _HASH_BITS) - 1)).astype(np.uint32)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each bucket, in order."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, edges) if len(order) else []:
        yield int(bucket[part[0]]), part


def probes(texts: list, words: WordCodes, block: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Step 1 for one cell: per bucket, hashes with two marks: is a block, occurs in two texts."""
    hashes, own, blocks = [], [], []
    for i, text in enumerate(texts):
        found = window_hashes(words.of(words_of(text)), block)
        is_block = np.zeros(len(found), bool)
        is_block[::block] = True
        hashes.append(found)
        blocks.append(is_block)
        own.append(np.full(len(found), i, np.int32))
    every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    if not len(every):
        return
    owner, is_block = np.concatenate(own), np.concatenate(blocks)
    order = np.argsort(every, kind="stable")
    every, owner, is_block = every[order], owner[order], is_block[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    marked = np.maximum.reduceat(is_block, first)
    several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
    bucket, short = _short(every[first], buckets)
    sent = short << np.uint32(2) | marked.astype(np.uint32) << np.uint32(1) | several.astype(np.uint32)
    for b, part in _by_bucket(bucket):
        yield b, np.sort(sent[part]).tobytes()


def hits(cells: np.ndarray, sent: list[bytes]) -> list[tuple[int, bytes]]:
    """Step 1 for one bucket: the shared hashes of each cell."""
    parts = [np.frombuffer(x, np.uint32) for x in sent]
    cell = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    every = np.concatenate(parts)
    order = np.argsort(every >> np.uint32(2), kind="stable")
    key, mark = (every >> np.uint32(2))[order], (every & np.uint32(3))[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([first, [len(key)]]))
    mark = np.bitwise_or.reduceat(mark, first)
    good = (mark & 2 > 0) & ((count > 1) | (mark & 1 > 0))
    chosen = np.repeat(good, count)
    key, cell = key[chosen], cells[cell[order[chosen]]]
    return [(c, np.unique(key[part]).tobytes()) for c, part in _by_cell(cell)]


def _by_cell(cell: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(cell, kind="stable")
    edges = np.flatnonzero(np.diff(cell[order])) + 1
    for part in np.split(order, edges) if len(order) else []:
        yield int(cell[part[0]]), part


def _wide(codes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    return window_hashes(codes, window), window_hashes(codes, window, second=True)


def _key(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    out = np.empty(len(h), _WIDE)
    out["h"], out["g"] = h, (g & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _result(doc: int | None, text: str | None, words: list[bytes], gone: np.ndarray | None, cell: int | None = None) -> tuple:
    if cell is not None:
        return (doc, None, None, None, None, cell, text)
    if gone is None or not gone.any():
        return (doc, len(words), 0, [], b" ".join(words).decode(), None, None)
    kept = b" ".join([w for w, x in zip(words, gone.tolist()) if not x]).decode()
    spans = [{"start": a, "end": b} for a, b in runs(gone)]
    return (doc, len(words), int(gone.sum()), spans, kept, None, None)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def cell_starts(rows: DataFrame, cells: int, cell_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """The lowest id of every cell, and in how many parts its rows are dealt by their text; of ``doc_id, text`` with ids.

    Ids are put in order and their texts' bytes added up, so a cell holds about ``cell_bytes``, however ids are spread. Only
    rows that share an id can be more; they are the ones dealt in parts. Fetched are a few numbers a cell.
    """
    step = max(1, cell_bytes // 8)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            ids, size = batch.column("doc_id").to_numpy(), batch.column("size").to_numpy()
            end = before + np.cumsum(size)
            change = (end - size)[1:] // step != (end - size)[:-1] // step
            first = np.flatnonzero(np.concatenate([[True], change])) if len(ids) else np.empty(0, int)
            before = int(end[-1]) if len(ids) else before
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(np.add.reduceat(size, first))], ["id", "size"])

    sizes = rows.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"))
    ordered = sizes.repartitionByRange(pieces(cells, 64), "doc_id").sortWithinPartitions("doc_id")
    found = ordered.mapInArrow(blocks, "id long, size long").groupBy("id").agg(F.sum("size").alias("size")).toPandas().sort_values("id")
    starts, sums = [], []
    for i, size in zip(found["id"].tolist(), found["size"].tolist()):
        if starts and sums[-1] + size <= cell_bytes:
            sums[-1] += size
        else:
            starts.append(i)
            sums.append(size)
    return np.array(starts, np.int64), np.array([pieces(x, cell_bytes) for x in sums], np.int64)


def in_cells(rows: DataFrame, starts: np.ndarray, parts: np.ndarray) -> DataFrame:
    """``rows`` with their ``cell``."""
    first = np.cumsum(parts) - parts

    @F.pandas_udf("long")
    def cell(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        at = np.maximum(np.searchsorted(starts, ids.to_numpy(), "right") - 1, 0)
        return pd.Series(first[at] + hashes.to_numpy() % parts[at])

    return rows.withColumn("cell", cell("doc_id", F.xxhash64("text")))


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    cell_bytes: int = 4 << 20,
    bucket_bytes: int = 8 << 20,
) -> DataFrame:
    """Removes every word that lies in a window of ``window`` words which a document with a smaller id has too.

    Returns for every row ``doc_id, n_words, n_removed, spans`` (the removed maximal repeats, in words, half
    open) and ``kept_text`` (the other words, joined by one space). Windows are judged on the input, so
    the result does not depend on any order. Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts
    have no words and an empty ``kept_text``; a repeat within one document, or between rows
    that share an id, is no repeat; rows without an id keep all words and count for nothing. No rows
    give no rows. Other columns are not read. ``window`` must be at least 2.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = max(1, text_bytes(rows, "text"))
    buckets = min(pieces(size, bucket_bytes), 1 << _BUCKET_BITS)
    block = window // 2
    with_id = rows.where("doc_id IS NOT NULL")
    named = in_cells(with_id, *cell_starts(with_id, pieces(size, cell_bytes), cell_bytes))

    sent_schema = pa.schema([("bucket", pa.int32()), ("cell", pa.int64()), ("sent", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordCodes()
        for batch in batches:
            cell, texts = batch.column("cell").to_numpy(), batch.column("text")
            for c, part in _by_cell(cell):
                for at in _slices(texts, part, cell_bytes):
                    out = [(b, c, x) for b, x in probes(texts.take(pa.array(at)).to_pylist(), words, block, buckets)]
                    yield from _batch(out, sent_schema).to_batches()

    def match(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        found = hits(table.column("cell").to_numpy(), table.column("sent").to_pylist())
        return _batch([(bucket, c, x) for c, x in found], sent_schema)

    sent = named.mapInArrow(send, "bucket int, cell long, sent binary")
    back = sent.groupBy("bucket").applyInArrow(match, "bucket int, cell long, sent binary")
    back = stored(back.select(F.col("cell").alias("to"), "bucket", F.col("sent").alias("hashes")), "anchor-hits")

    wide_schema = [("bucket", pa.int32()), ("wide", pa.binary()), ("lows", pa.binary())]
    extended_schema = pa.schema([*_OUT, *wide_schema])
    none = (None,) * len(_OUT)

    def extend(texts: pa.Table, found: pa.Table) -> pa.Table:
        known: dict[int, list[bytes]] = {}
        for b, x in zip(found.column("bucket").to_pylist(), found.column("hashes").to_pylist()):
            known.setdefault(b, []).append(x)
        keys = np.sort(np.concatenate([np.frombuffer(x, np.uint32).astype(np.uint64) | np.uint64(b << _HASH_BITS) for b, p in known.items() for x in p])) if known else None
        words, out, hs, gs, ids = WordCodes(), [], [], [], []
        for doc, text in zip(texts.column("doc_id").to_pylist(), texts.column("text").to_pylist()):
            own = words_of(text)
            starts = np.empty(0, int)
            if keys is not None and len(own) >= window:
                codes = words.of(own)
                bucket, short = _short(window_hashes(codes, block), buckets)
                mine = short.astype(np.uint64) | bucket.astype(np.uint64) << np.uint64(_HASH_BITS)
                at = np.searchsorted(keys, mine)
                hit = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == mine)
                back_by = window - block
                near = covered(np.maximum(hit - back_by, 0), back_by + 1, len(own))[: len(own) - window + 1] if len(hit) else np.zeros(1, bool)
                starts = np.flatnonzero(near)
            if not len(starts):
                out.append(_result(doc, text, own, None))
                continue
            out.append(_result(doc, text, own, None, int(texts.column("cell")[0].as_py())))
            h, g = _wide(codes, window)
            hs.append(h[starts])
            gs.append(g[starts])
            ids.append(np.full(len(starts), doc, np.int64))
        rows_out = [(*r, None, None, None) for r in out]
        if hs:
            h, g, doc = np.concatenate(hs), np.concatenate(gs), np.concatenate(ids)
            key = _key(h, g)
            order = np.lexsort((doc, key["g"], key["h"]))
            key, doc, g = key[order], doc[order], g[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, doc, g = key[first], doc[first], g[first]
            cell = int(texts.column("cell")[0].as_py())
            for b, part in _by_bucket(_short(g, buckets)[0]):
                again = part[np.argsort(doc[part], kind="stable")]
                rows_out.append((*none[:5], cell, None, b, key[again].tobytes(), doc[again].tobytes()))
        return _batch(rows_out, extended_schema)

    schema = RESULT + ", cell long, open_text string, bucket int, wide binary, lows binary"
    hit_cells = named.groupBy("cell").cogroup(back.groupBy("to"))
    extended = stored(hit_cells.applyInArrow(extend, schema), "anchor-windows")
    done = extended.where("bucket IS NULL AND open_text IS NULL").select("doc_id", "n_words", "n_removed", "spans", "kept_text")

    low_schema = pa.schema([("to", pa.int64()), ("wide", pa.binary()), ("lows", pa.binary())])

    def lowest(table: pa.Table) -> pa.Table:
        wide = [np.frombuffer(x, _WIDE) for x in table.column("wide").to_pylist()]
        key, doc = np.concatenate(wide), np.concatenate([np.frombuffer(x, np.int64) for x in table.column("lows").to_pylist()])
        cell = np.repeat(table.column("cell").to_numpy(), [len(x) for x in wide])
        order = np.lexsort((doc, key["g"], key["h"]))
        key, doc, cell = key[order], doc[order], cell[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        least = np.repeat(doc[first], np.diff(np.concatenate([first, [len(key)]])))
        told = least < doc
        key, least, cell = key[told], least[told], cell[told]
        return _batch([(c, key[p].tobytes(), least[p].tobytes()) for c, p in _by_cell(cell)], low_schema)

    windows = extended.where("bucket IS NOT NULL").select("bucket", "cell", "wide", "lows")
    told = windows.groupBy("bucket").applyInArrow(lowest, "to long, wide binary, lows binary")

    result_schema = pa.schema(list(_OUT)[:5])

    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _batch([], result_schema)
        words = WordCodes()
        docs_, lists = texts.column("doc_id").to_numpy(), [words_of(t) for t in texts.column("open_text").to_pylist()]
        keys = [_key(*_wide(words.of(x), window)) for x in lists]
        key, doc = np.concatenate(keys), np.repeat(docs_, [len(x) for x in keys])
        outer = [np.frombuffer(x, _WIDE) for x in answers.column("wide").to_pylist()]
        given = [np.frombuffer(x, np.int64) for x in answers.column("lows").to_pylist()]
        both, low_of = np.concatenate([key, *outer]), np.concatenate([doc, *given])
        _, inverse = np.unique(both, return_inverse=True)
        least = np.full(inverse.max() + 1 if len(inverse) else 0, np.iinfo(np.int64).max)
        np.minimum.at(least, inverse, low_of)
        gone = least[inverse[: len(key)]] < doc
        out, at = [], 0
        for d, own, k in zip(docs_.tolist(), lists, keys):
            starts = np.flatnonzero(gone[at : at + len(k)])
            out.append(_result(d, None, own, covered(starts, window, len(own)))[:5])
            at += len(k)
        return _batch(out, result_schema)

    waiting = extended.where("open_text IS NOT NULL").select("cell", "doc_id", "open_text")
    rest = waiting.groupBy("cell").cogroup(told.groupBy("to")).applyInArrow(cut, RESULT)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = batch.column("text").slice(at, 256).to_pylist()
                yield from _batch([_result(None, t, words_of(t), None)[:5] for t in texts], result_schema).to_batches()

    nameless = rows.where("doc_id IS NULL").mapInArrow(plain, RESULT)
    return done.unionByName(rest).unionByName(nameless)


def _slices(texts: pa.Array, places: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Places cut where the texts' bytes pass ``limit``."""
    size = np.cumsum([len(texts[int(i)].as_buffer() or b"") if texts[int(i)].is_valid else 0 for i in places])
    part = size // limit
    for p in np.unique(part):
        yield places[part == p]
