"""Token ids in wavelet matrices, one file for a shard of consecutive documents.

A wavelet matrix keeps the bits of all ids plane by plane, highest first; behind each plane the ids are
parted stably into those with a zero and those with a one. Counts of ones up to a place (rank) then
lead from plane to plane, so a file answers, without being unpacked whole: the id at a place, how
often an id occurs in a range, and where it occurs the k-th time.

File: magic, header length, header (JSON: sizes, zeros of each plane, block directory), document
table, blocks. A block is ``BLOCK`` bits of a plane, compressed by itself, with the count of ones
before it in the directory; a reader unpacks the blocks that it touches.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridelake.llm.shared import pieces, stored, text_bytes
from ridelake.llm.tokens import encoder
from ridelake.llm.warc import file_system

MAGIC = b"WVMX0001"
BLOCK = 1 << 17  # bits


# One file


def matrix_bytes(ids: np.ndarray, bits: int, doc_ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The file of a shard. ``doc_ids`` holds masked null ids as the smallest 64-bit number."""
    packer = zstandard.ZstdCompressor(level=1)
    zeros, directory, blocks, at = [], [], [], 0
    for plane in range(bits - 1, -1, -1):
        bit = (ids >> plane & 1).astype(bool)
        packed, ones = np.packbits(bit, bitorder="little"), 0
        own = []
        for begin in range(0, len(packed), BLOCK // 8):
            part = packed[begin : begin + BLOCK // 8]
            data = packer.compress(part.tobytes())
            own.append((at, len(data), ones))
            ones += int(np.bitwise_count(part).sum())
            at += len(data)
            blocks.append(data)
        zeros.append(len(ids) - ones)
        directory.append(own)
        ids = np.concatenate([ids[~bit], ids[bit]])
    table = packer.compress(doc_ids.astype("<i8").tobytes() + lengths.astype("<i8").tobytes())
    head = {"n": len(ids), "bits": bits, "zeros": zeros, "blocks": directory, "docs": len(doc_ids), "table": len(table)}
    header = packer.compress(json.dumps(head).encode())
    return MAGIC + struct.pack("<I", len(header)) + header + table + b"".join(blocks)


class WaveletFile:
    """Reads one file through ``read(offset, size)``."""

    def __init__(self, read) -> None:
        start = read(0, 12)
        if start[:8] != MAGIC:
            raise ValueError("not a wavelet matrix")
        size = struct.unpack("<I", start[8:])[0]
        head = json.loads(zstandard.decompress(read(12, size)))
        self.n, self.bits, self.zeros, self.blocks = head["n"], head["bits"], head["zeros"], head["blocks"]
        table = np.frombuffer(zstandard.decompress(read(12 + size, head["table"])), "<i8")
        self.doc_ids, self.lengths = table[: head["docs"]], table[head["docs"] :]
        self.base, self.read, self.open = 12 + size + head["table"], read, {}

    def _block(self, level: int, block: int) -> np.ndarray:
        key = (level, block)
        if key not in self.open:
            offset, size, _ = self.blocks[level][block]
            self.open[key] = np.frombuffer(zstandard.decompress(self.read(self.base + offset, size)), np.uint8)
        return self.open[key]

    def rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if i <= 0 or not self.blocks[level]:
            return 0
        block, rest = divmod(i, BLOCK)
        if block == len(self.blocks[level]):
            block, rest = block - 1, BLOCK
        data = self._block(level, block)
        whole, odd = divmod(rest, 8)
        ones = int(np.bitwise_count(data[:whole]).sum()) + (int(data[whole] & (1 << odd) - 1).bit_count() if odd else 0)
        return self.blocks[level][block][2] + ones

    def bit(self, level: int, i: int) -> int:
        data = self._block(level, i // BLOCK)
        return int(data[i % BLOCK // 8] >> i % 8 & 1)

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.bits):
            one = self.bit(level, i)
            value = value << 1 | one
            ones = self.rank1(level, i)
            i = self.zeros[level] + ones if one else i - ones
        return value

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self.rank1(level, begin), self.rank1(level, end)
            one = token >> self.bits - 1 - level & 1
            begin, end = (self.zeros[level] + a, self.zeros[level] + b) if one else (begin - a, end - b)
        return begin, end

    def count(self, token: int, begin: int, end: int) -> int:
        """How often ``token`` stands in places ``begin`` to ``end`` (not included)."""
        a, b = self._range(token, max(begin, 0), min(end, self.n))
        return max(0, b - a)

    def _select(self, level: int, one: int, k: int) -> int:
        """Place of the ``k``-th (from 0) bit of a kind in a plane."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self.rank1(level, mid + 1)
            if (ones if one else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def select(self, token: int, k: int) -> int | None:
        """The place of the ``k``-th occurrence (from 0) of ``token``, null if there are fewer."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            return None
        i = a + k
        for level in range(self.bits - 1, -1, -1):
            one = token >> self.bits - 1 - level & 1
            i = self._select(level, one, i - self.zeros[level] if one else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids, by undoing the partings from the last plane up."""
        values = np.zeros(self.n, np.uint32)
        for level in range(self.bits - 1, -1, -1):
            parts = [zstandard.decompress(self.read(self.base + o, s)) for o, s, _ in self.blocks[level]]
            bit = np.unpackbits(np.frombuffer(b"".join(parts), np.uint8), bitorder="little", count=self.n).astype(bool)
            out = np.empty_like(values)
            out[~bit] = values[: self.zeros[level]]
            out[bit] = values[self.zeros[level] :] | np.uint32(1 << self.bits - 1 - level)
            values = out
        return values


def open_file(path: str) -> WaveletFile:
    fs, name = file_system(path)
    file = fs.open_input_file(name)
    return WaveletFile(lambda offset, size: file.read_at(size, offset))


# Spark

SHARDS = "path string, first_id long, part int, n_docs long, n_tokens long"
_NULL_ID = np.iinfo(np.int64).min


def write_shards(
    docs: DataFrame,
    folder: str,
    *,
    path: str,
    keeps_space: bool = False,
    end_id: int = 1,
    bits: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = 24 << 20,
) -> DataFrame:
    """Encodes whole texts, appends ``end_id``, and writes them in ascending id order, a file for each shard.

    Returns ``path, first_id, part, n_docs, n_tokens, base`` of every shard; ``base`` counts the ids of all shards before
    it. A null text is an empty one; rows without an id come first; rows that share an id stay
    together in either order. No rows give no files. An id of ``bits`` bits or more is an error.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shards = pieces(text_bytes(rows, "text"), shard_bytes)
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, ids, lengths, names, size, part = encoder(path, keeps_space), [], [], [], 0, 0
        end = np.array([end_id], encode.dtype)

        def flush() -> pd.DataFrame:
            every = np.concatenate(ids)
            if int(every.max()) >> bits:
                raise ValueError(f"a token id does not fit in {bits} bits")
            known = [_NULL_ID if pd.isna(x) else int(x) for x in names]
            data = matrix_bytes(every, bits, np.array(known, np.int64), np.array(lengths, np.int64))
            fs, base = file_system(folder)
            name = f"shard-{uuid.uuid4().hex}.wvm"
            with fs.open_output_stream(f"{base.rstrip('/')}/{name}", compression=None) as file:
                file.write(data)
            first = None if known[0] == _NULL_ID else known[0]
            return pd.DataFrame({"path": [f"{folder.rstrip('/')}/{name}"], "first_id": pd.array([first], "Int64"), "part": [part], "n_docs": [len(names)], "n_tokens": [len(every)]})

        for batch in batches:
            for doc, found in zip(batch["doc_id"], encode.encode_all(batch["text"])):
                own = np.append(found, end)
                ids.append(own)
                lengths.append(len(own))
                names.append(doc)
                size += len(own)
                if size >= shard_bytes // 2:
                    yield flush()
                    ids, lengths, names, size, part = [], [], [], 0, part + 1
        if names:
            yield flush()

    written = stored(ordered.mapInPandas(write, SHARDS), "wavelet-shards")
    # One row for a file of tens of megabytes: the running sum is over a few rows for each terabyte.
    before = Window.orderBy(F.asc_nulls_first("first_id"), "part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"]):
                file = open_file(path)
                ids = file.decode().astype("<u4")
                ends = np.cumsum(file.lengths)
                starts = ends - file.lengths
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                names = pd.array([None if x == _NULL_ID else int(x) for x in file.doc_ids], "Int64")
                yield pd.DataFrame({"doc_id": names, "start": starts + int(base), "n_tokens": file.lengths, "ids_crc32": crc})

    dealt = shards.select("path", "base").repartition(pieces(shards.count(), 1), "path")
    return dealt.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """``path, n, place``: how often each shard holds ``token`` and where (over all ids), by rank and select alone."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"]):
                file = open_file(path)
                n = file.count(token, 0, file.n)
                yield pd.DataFrame({"path": [path] * n, "n": [n] * n, "place": [int(base) + file.select(token, k) for k in range(n)]})

    return shards.select("path", "base").mapInPandas(look, "path string, n long, place long")
