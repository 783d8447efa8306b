"""Web archives as seekable Zstandard bundles.

A bundle is a sequence of independent Zstandard frames, each holding a few whole WARC records,
followed by a skippable frame with a seek table (the public seekable format: sizes of every frame,
then a nine-byte footer). Any Zstandard tool reads the whole; a reader with the footer gets one
frame without touching the others. An index maps record identifiers to (bundle, frame, offset in
the frame, length).

Executors write bundles straight to a folder that all of them share. Every attempt of a task takes
file names of its own and only finished tasks report theirs, so lost executors and retries leave
files that nothing refers to, and never half a bundle that something does.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm.shared import pieces, stored

# Fixed values of the public formats.
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEK_FOOTER_MAGIC = 0x8F92EAB1
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_URN = "urn:x-record:"
INDEX_SCHEMA = "record_id long, path string, frame int, offset long, length long"
FRAME_SCHEMA = "path string, frame int, start long, packed_bytes long, plain_bytes long"
RECORD_SCHEMA = (
    "record_id long, record_type string, refers_to long, target_uri string, payload_bytes long, "
    "payload_digest string, payload binary"
)


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", uri))


# Records


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(record_id: int | None) -> str:
    return f"<{RECORD_URN}{'none' if record_id is None else record_id}>"


def _id_of(field: str | None) -> int | None:
    number = (field or "").strip("<>").removeprefix(RECORD_URN)
    return int(number) if re.fullmatch(r"-?\d+", number) else None


def record_bytes(record_id: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record. A revisit keeps the response's header lines and leaves the payload out."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", uri or urn(record_id).strip("<>"))
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {urn(record_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        fields += [f"WARC-Profile: {IDENTICAL_PAYLOAD}", f"WARC-Refers-To: {urn(refers_to)}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: bytes) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines.decode().split("\r\n")[1:])}


def parse_records(data: bytes) -> Iterator[tuple]:
    """Rows of ``RECORD_SCHEMA`` from a whole frame. A payload that differs from its digest is an error."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        fields = _fields(data[at:head_end])
        begin = head_end + 4
        end = begin + int(fields["content-length"])
        http_end = data.index(b"\r\n\r\n", begin, end) + 4
        size = int(_fields(data[begin : http_end - 4])["content-length"])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        payload = None
        if fields["warc-type"] == "response":
            payload = data[http_end:end]
            if len(payload) != size or base32_sha1(payload) != digest:
                raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
        yield (
            _id_of(fields["warc-record-id"]),
            fields["warc-type"],
            _id_of(fields.get("warc-refers-to")),
            fields["warc-target-uri"],
            size,
            digest,
            payload,
        )
        at = end + 4


# Bundles


class Bundle:
    """Writes one bundle, frame by frame; holds no more than the open frame."""

    def __init__(self, folder: str, frame_bytes: int, level: int) -> None:
        self.fs, base = file_system(folder)
        self.path = f"{folder.rstrip('/')}/bundle-{uuid.uuid4().hex}.warc.zst"
        self.file = self.fs.open_output_stream(f"{base.rstrip('/')}/{self.path.rpartition('/')[2]}", compression=None)
        self.frame_bytes, self.packer = frame_bytes, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.open, self.open_bytes, self.frames, self.written, self.index = [], 0, [], 0, []

    def add(self, record_id: int | None, record: bytes) -> None:
        if self.open and self.open_bytes + len(record) > self.frame_bytes:
            self._flush()
        self.index.append((record_id, self.path, len(self.frames), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)

    def _flush(self) -> None:
        packed = self.packer.compress(b"".join(self.open))
        self.file.write(packed)
        self.frames.append((len(packed), self.open_bytes))
        self.written += len(packed)
        self.open, self.open_bytes = [], 0

    def close(self) -> list[tuple]:
        if self.open:
            self._flush()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEK_FOOTER_MAGIC)
        self.file.write(struct.pack("<II", SEEK_TABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.file.close()
        return self.index


def seek_table(path: str) -> list[tuple]:
    """Rows of ``FRAME_SCHEMA`` of one bundle, read from its end alone."""
    fs, name = file_system(path)
    with fs.open_input_file(name) as file:
        size = file.size()
        count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEK_FOOTER_MAGIC:
            raise ValueError(f"{path} has no seek table")
        table = struct.unpack(f"<{2 * count}I", file.read_at(8 * count, size - 9 - 8 * count))
    rows, start = [], 0
    for frame in range(count):
        packed, plain = table[2 * frame], table[2 * frame + 1]
        rows.append((path, frame, start, packed, plain))
        start += packed
    return rows


def read_frame(path: str, start: int, packed: int, plain: int) -> bytes:
    fs, name = file_system(path)
    with fs.open_input_file(name) as file:
        return zstandard.ZstdDecompressor().decompress(file.read_at(packed, start), max_output_size=plain)


# Spark


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


_INDEX = pa.schema([("record_id", pa.int64()), ("path", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
_FRAMES = pa.schema([("path", pa.string()), ("frame", pa.int32()), ("start", pa.int64()), ("packed_bytes", pa.int64()), ("plain_bytes", pa.int64())])
_RECORDS = pa.schema(
    [
        ("record_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("target_uri", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def with_originals(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """Adds ``refers_to``: of rows with one payload, all but those with the smallest id refer to it.

    Only digests are grouped, so a payload that a third of all rows share is summed before the
    shuffle; the join back is an equi-join that adaptive execution splits where it is hot.
    """
    key = ["_digest", "_size"]
    keyed = pages.withColumns({"_digest": F.sha1(F.encode("payload", "UTF-8")), "_size": F.octet_length("payload")})
    first = keyed.where(F.col("_size") >= min_revisit_bytes).groupBy(*key).agg(F.min("record_id").alias("_first"), F.count("*").alias("_n"))
    shared = first.where("_n > 1").drop("_n")
    original = F.when(F.col("record_id").eqNullSafe(F.col("_first")), F.lit(None)).otherwise(F.col("_first"))
    return keyed.join(shared, key, "left").withColumn("refers_to", original).drop("_first", "_size")


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    frame_bytes: int = 256 << 10,
    bundle_bytes: int = 512 << 20,
    level: int = 3,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a record per row and returns the index of records (``INDEX_SCHEMA``).

    Of equal payloads of ``min_revisit_bytes`` or more, rows with the smallest id become responses
    (every such row, should the id repeat) and the others revisits of it. A null payload is an empty
    one, a null uri the record's own identifier, a null id a record that nothing refers to unless
    all copies have none, when all are responses. A record longer than a frame has a frame to
    itself. No rows give no bundle and an empty index. Other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("record_id"),
        F.col(uri_col).cast("string").alias("uri"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            for row in batch.to_pylist():
                if bundle is None:
                    bundle = Bundle(folder, frame_bytes, level)
                digest = base64.b32encode(bytes.fromhex(row["_digest"])).decode()
                record = record_bytes(row["record_id"], row["uri"], row["payload"].encode(), digest, row["refers_to"], date)
                bundle.add(row["record_id"], record)
                if bundle.written >= bundle_bytes:
                    yield _table(bundle.close(), _INDEX)
                    bundle = None
        if bundle is not None:
            yield _table(bundle.close(), _INDEX)

    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    return stored(with_originals(rows, min_revisit_bytes).mapInArrow(write, INDEX_SCHEMA), "warc-index")


def frames(bundles: DataFrame) -> DataFrame:
    """The seek tables of the bundles named in column ``path``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield _table(seek_table(path), _FRAMES)

    paths = stored(bundles.select("path").distinct(), "bundles")
    return paths.repartition(pieces(paths.count(), 64), "path").mapInArrow(read, FRAME_SCHEMA)


def read_archives(bundles: DataFrame, with_payload: bool = True, task_bytes: int = 32 << 20) -> DataFrame:
    """All records (``RECORD_SCHEMA``) of the bundles named in column ``path``.

    Frames are dealt out by what they hold, not bundles, so one large bundle is read by many tasks.
    Payloads are checked against their digests also where they are not returned.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                rows = parse_records(read_frame(x["path"], x["start"], x["packed_bytes"], x["plain_bytes"]))
                yield _table([r if with_payload else (*r[:-1], None) for r in rows], _RECORDS)

    places = stored(frames(bundles), "frames")
    held = places.agg(F.sum("plain_bytes").alias("n")).first().n or 0
    return places.repartition(pieces(held, task_bytes), "path", "frame").mapInArrow(read, RECORD_SCHEMA)


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records whose identifiers stand in ``wanted.record_id``, by one range read of a frame each."""
    found = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    places = found.join(frames(found), ["path", "frame"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                plain = read_frame(x["path"], x["start"], x["packed_bytes"], x["plain_bytes"])
                yield _table(list(parse_records(plain[x["offset"] : x["offset"] + x["length"]])), _RECORDS)

    return places.mapInArrow(read, RECORD_SCHEMA)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages`` and reads them back: what each page has become."""
    index = write_archives(pages, folder)
    return read_archives(index, with_payload=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"
    )
