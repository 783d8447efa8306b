from __future__ import annotations

import base64
import hashlib
import random

import zstandard
from pyspark.sql import functions as F

from ridelake.llm import warc

SCHEMA = "page_id long, url string, html string, record_id int, path string, refers_to string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/1", "<p>x</p>"),
    (2, "http://a/2", "<p>x</p>"),
    (3, None, None),
    (4, "http://a b\r\nX: y", ""),
    (5, "http://a/5", "é\r\n\r\nWARC/1.1\r\n" * 3),
    (6, "", "long " * 200_000),
    (-7, "http://a/7", "<p>x</p>"),
    (None, "http://a/none", "<p>x</p>"),
    (None, "http://a/alone", "alone"),
    (8, "http://a/8", "twice"),
    (8, "http://a/8", "twice"),
]


def test_records_come_back(spark, folder):
    rows = ROWS + [(100 + i, f"http://b/{i}", "page " * (i % 7)) for i in range(300)]
    index = warc.write_archives(pages(spark, rows), folder, frame_bytes=2000)
    back = warc.read_archives(index).collect()
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = [(i, sha(h), len((h or "").encode()), first.get(h or "") if first.get(h or "", i) != i else None) for i, _, h in rows]
    got = [(r.record_id, r.payload_digest, r.payload_bytes, r.refers_to) for r in back]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in back)
    assert all(r.payload is None if r.refers_to is not None else len(r.payload) == r.payload_bytes for r in back)


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, folder):
    index = warc.write_archives(pages(spark, ROWS), folder, frame_bytes=1000)
    for path in {r.path for r in index.collect()}:
        fs, name = warc.file_system(path)
        data = fs.open_input_file(name).read()
        with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as reader:
            whole = reader.read()
        frames = warc.seek_table(path)
        assert sum(f[4] for f in frames) == len(whole)
        assert whole == b"".join(warc.read_frame(f[0], *f[2:]) for f in frames)


def test_fetch_by_identifier(spark, folder):
    rows = [(i, f"u{i}", f"page {i} " * random.Random(i).randrange(1, 60)) for i in range(200)]
    index = warc.write_archives(pages(spark, rows), folder, frame_bytes=3000)
    wanted = spark.createDataFrame([(3,), (150,), (999,)], "record_id long")
    found = {r.record_id: bytes(r.payload).decode() for r in warc.fetch(index, wanted).collect()}
    assert found == {i: h for i, _, h in rows if i in (3, 150)}


def test_small_payloads_are_never_revisits(spark, folder):
    index = warc.write_archives(pages(spark, [(1, "a", "xx"), (2, "b", "xx")]), folder, min_revisit_bytes=3)
    assert {r.record_type for r in warc.read_archives(index).collect()} == {"response"}


def test_no_rows(spark, folder):
    index = warc.write_archives(pages(spark, []), folder)
    assert index.count() == 0 and warc.read_archives(index).count() == 0


def test_registered_query(spark):
    from ridelake.llm.queries import QUERIES

    data = "/root/testdata/sf0.001"
    want = [(r.page_id, len((r.html or "").encode()), sha(r.html)) for r in spark.read.parquet(f"{data}/pages.parquet").collect()]
    got = QUERIES["op4_seekable_bundles"](spark, data)
    assert sorted(tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest").collect()) == sorted(want)
    assert got.where((F.col("record_type") == "revisit") != F.col("refers_to").isNotNull()).count() == 0
