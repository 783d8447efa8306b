"""Ranked lexical search by NRA: impact-sorted lists read in sequence, a score interval kept for every document.

1. One pass over the texts counts each document's terms and keeps the frequencies of the terms asked for; it is
   written to the shared folder. Statistics of the corpus come from that table and cover all documents.
2. Documents are searched where they lie, a shard at a time: a shard holds at most ``shard_postings`` postings (or one
   document), so no list grows with the corpus, however common its term. Each list is sorted by falling
   impact and only ever read onwards. After a round of reads a document's score is at least what was read of it
   and at most that plus the next impact of every list it has not been met in. Reading goes on until no document
   outside the best can reach them, and those that can have no open interval left: membership, ties and scores
   are then exact.
3. A task carries the best of its earlier shards into the next one as a threshold and reports them once, so that
   what is merged per item is ``k`` rows a task.

Items are the queries: they are taken in blocks of bounded size, each block searched against all documents.

Results of special cases: a null text, and one without a term, is no document for the statistics and is never found. An
item without terms, or whose terms no document holds, gives no rows. Each row of the table is a document by itself,
also where ids repeat; of equal scores the smaller id is first, a null id last. Repeated item rows are answered once,
different texts of one item id each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Set
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.shared import pieces, stored

# Every ASCII character but letters and digits parts terms; only A-Z change their case.
_FOLD = bytes(
    x + 32 if 0x41 <= x <= 0x5A else x if x >= 0x80 or 0x30 <= x <= 0x39 or 0x61 <= x <= 0x7A else 0x20 for x in range(256)
)
SLICE_BYTES = 1 << 20
_TOP_IMPACT = 1_000_000  # no impact exceeds 10^9 tf / 1000 tf
FIRST_DEPTH = 128


def term_slices(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists of bounded size."""
    at = 0
    while at < len(text):
        end = at + SLICE_BYTES
        part = text[at:end].translate(_FOLD)
        # A slice ends behind a separator; a term longer than a slice takes as many bytes as it needs.
        while end < len(text) and (cut := part.rfind(b" ")) < 0:
            part += text[end : end + SLICE_BYTES].translate(_FOLD)
            end += SLICE_BYTES
        if end < len(text):
            part = part[: cut + 1]
        at += len(part)
        yield part.split()


def count_terms(text: bytes | None, known: Set[bytes]) -> tuple[int, Counter]:
    """The number of terms, and the frequencies of those that are known."""
    n, counts = 0, Counter()
    for terms in term_slices(text or b""):
        n += len(terms)
        found = Counter(terms)
        for t in found.keys() & known:
            counts[t] += found[t]
    return n, counts


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass
class Shard:
    """Impact-sorted lists of one shard: of term ``t`` the entries ``starts[t]`` to ``starts[t + 1]``."""

    starts: np.ndarray
    docs: np.ndarray
    impacts: np.ndarray
    size: int


def shard_of(terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_terms: int, size: int) -> Shard:
    order = np.argsort(terms.astype(np.int64) << 20 | (_TOP_IMPACT - impacts), kind="stable")
    starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
    return Shard(starts, docs[order], impacts[order], size)


@dataclass
class Reader:
    """One list, read from its largest impact onwards."""

    docs: np.ndarray
    scores: np.ndarray
    at: int = 0
    bottom: int = field(init=False)  # no unread entry scores more

    def __post_init__(self) -> None:
        self.bottom = int(self.scores[0])


def top_of_shard(shard: Shard, terms: list[int], weights: list[int], k: int, threshold: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Documents (places in the shard) that may be among the best ``k``, with exact scores; all score at least ``threshold``.

    Whoever is left out has a score below ``threshold``, or ``k`` others with a greater one.
    """
    lists = []
    for t, w in zip(terms, weights):
        lo, hi = shard.starts[t], shard.starts[t + 1]
        if hi > lo and w > 0:
            lists.append(Reader(shard.docs[lo:hi], shard.impacts[lo:hi] * w))
    lower = np.zeros(shard.size, np.int64)
    covered = np.zeros(shard.size, np.int64)  # sum of the bottoms of the lists a document was met in
    candidates, depth = None, FIRST_DEPTH
    open_lists = lists
    while True:
        for r in open_lists:
            until = min(len(r.docs), r.at + depth)
            bottom = int(r.scores[until]) if until < len(r.docs) else 0
            if r.at and bottom != r.bottom:
                covered[r.docs[: r.at]] -= r.bottom - bottom
            fresh = r.docs[r.at : until]
            lower[fresh] += r.scores[r.at : until]
            covered[fresh] += bottom
            r.at, r.bottom = until, bottom
        depth *= 2
        ceiling = sum(r.bottom for r in lists)  # of a document not met so far
        if candidates is None:
            seen = np.flatnonzero(lower)
        else:
            seen = candidates
        if len(seen) >= k:
            threshold = max(threshold, int(np.partition(lower[seen], len(seen) - k)[len(seen) - k]))
        upper = lower[seen] + (ceiling - covered[seen])
        seen = seen[upper >= threshold]
        if ceiling < threshold:
            # Whoever was not met, or fell behind, never comes back: from here on the candidates only get fewer.
            candidates = seen
            if (covered[seen] == ceiling).all():
                return seen, lower[seen]
            mark = np.zeros(shard.size, bool)
            mark[seen] = True
            open_lists = [r for r in lists if r.at < len(r.docs) and np.count_nonzero(mark[r.docs[: r.at]]) < len(seen)]
        else:
            open_lists = [r for r in lists if r.at < len(r.docs)]


def _best(found: list[tuple], k: int) -> list[tuple]:
    """The first ``k`` of (score, id) pairs: greatest score, then smallest id, null last."""
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))[:k]


def postings(docs: DataFrame, vocabulary: list[bytes], *, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, number of terms, and terms of the vocabulary (by place) with their frequencies."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    places = {t: i for i, t in enumerate(vocabulary)}
    known = frozenset(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, terms, tfs = [], [0], [], []
            for text in batch.column("text"):
                n, counts = count_terms(text.as_py(), known)
                held = sorted((places[t], f) for t, f in counts.items())
                sizes.append(n)
                terms.extend(t for t, _ in held)
                tfs.extend(f for _, f in held)
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), *lists], ["id", "n", "terms", "tfs"])

    return rows.mapInArrow(count, f"id {kind}, n long, terms array<int>, tfs array<int>")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_items: int = 2_000,
    block_bytes: int = 16 << 20,
    shard_postings: int = 4_000_000,
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item, rank from 1, document, score.

    What is fetched and sent to tasks is a block of items (about ``block_items`` rows and ``block_bytes`` bytes) and
    the statistics of their terms; more items make more blocks.
    """
    asked = stored(items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text")).distinct(), "items")
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes")).first()
    blocks = max(pieces(size.n, block_items), pieces(size.bytes, block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    found = [
        _search_block(docs, asked.where(block == b).collect(), asked.schema["item"].dataType.simpleString(), k, id_col, text_col, shard_postings)
        for b in range(blocks)
    ]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _search_block(docs: DataFrame, rows: list, item_kind: str, k: int, id_col: str, text_col: str, shard_postings: int) -> DataFrame:
    spark = docs.sparkSession
    terms_of = [sorted(set().union(*term_slices((r.text or "").encode()))) for r in rows]
    vocabulary = sorted(set().union(*terms_of))
    places = {t: i for i, t in enumerate(vocabulary)}
    listed = stored(postings(docs, vocabulary, id_col=id_col, text_col=text_col), "postings")
    total = listed.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    documents, length = int(total.documents), int(total.terms)
    holding = dict(listed.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect())
    weights = [term_weight(documents, holding[i]) if i in holding else 0 for i in range(len(vocabulary))]
    # Terms that add nothing to any document are not read.
    questions = [[t for t in map(places.__getitem__, terms) if weights[t] > 0] for terms in terms_of]
    n_terms = len(vocabulary)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in questions]
        held: list[pa.RecordBatch] = []

        def settle() -> None:
            table = pa.Table.from_batches(held)
            ids = table.column("id")
            m = np.array([10 + 90 * n * documents // length if length else 0 for n in table.column("n").to_pylist()], np.int64)
            counts = table.column("terms").combine_chunks()
            terms = counts.flatten().to_numpy(zero_copy_only=False)
            tfs = table.column("tfs").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            per_doc = counts.value_lengths().to_numpy(zero_copy_only=False)
            at = np.repeat(np.arange(len(ids), dtype=np.int32), per_doc)
            shard = shard_of(terms, at, 1_000_000_000 * tfs // (1000 * tfs + 8 * m[at]), n_terms, len(ids))
            for q, own in enumerate(questions):
                least = best[q][-1][0] if len(best[q]) == k else 1
                where, scores = top_of_shard(shard, own, [weights[t] for t in own], k, least)
                if len(where):
                    names = ids.take(pa.array(where)).to_pylist()
                    best[q] = _best(best[q] + list(zip(scores.tolist(), names)), k)
            held.clear()

        waiting, id_type = 0, None
        for batch in batches:
            id_type = batch.schema.field("id").type
            # A batch may hold more than a shard: it is cut at documents.
            ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            start = 0
            while start < batch.num_rows:
                before = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + shard_postings - waiting, "right")))
                if held and int(ends[start]) - before > shard_postings - waiting:
                    settle()
                    waiting = 0
                    continue
                held.append(batch.slice(start, stop - start))
                waiting += int(ends[stop - 1]) - before
                start = stop
        if held:
            settle()
        rows_out = [(q, name, score) for q, own in enumerate(best) for score, name in own]
        if rows_out:
            q, names, scores = zip(*rows_out)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(names, id_type), pa.array(scores, pa.int64())], ["q", "id", "score"])

    kind = listed.schema["id"].dataType.simpleString()
    found = listed.mapInArrow(rank, f"q int, id {kind}, score long")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = spark.createDataFrame([(q, r.item) for q, r in enumerate(rows)], f"q int, item {item_kind}")
    return ranked.join(named, "q").select("item", "rank", "id", "score")
