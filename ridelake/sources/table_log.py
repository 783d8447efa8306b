"""Tables of plain Parquet files with numbered snapshots, updated by key.

Below a table's path lie

* ``data/<commit>/``: rows. All columns are inside the files, partition columns too, so values come back with their
  type and text as it was; a file holds rows of one partition.
* ``blooms/<commit>/``: for each data file a Bloom filter of its keys, written once.
* ``files/<id>/``: the files of a snapshot, with partition, number of rows and ranges of the keys.
* ``log/<number>.json``: what makes a snapshot: its schema, and which list of files it has. It appears by
  a rename that fails where the number is taken: two updates cannot both become the next snapshot, and a
  reader has either all of an update or nothing.

An update writes the rows received once, straight to where they stay. Old files are looked for by partition (where the key
fixes it), ranges and Bloom filters; key columns of those left, compared by 96 bits of hashes, tell which rows have a received
key, by file and place in it. Only files with such rows are read whole and written anew: each is given a bit for each of its rows, so the rows that
stay are not shuffled. What an update that failed leaves behind is in no snapshot.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.sources.files import (
    DATA_OPTIONS,
    PARTITIONS,
    ROWS_AT_ONCE,
    delete_folder,
    has_bit,
    key_digest,
    newest_per_key,
    refuse_repeated_keys,
    row_bits,
    spread_for_write,
    table_exists,
)

# Bits for each key, and bits set for it: one key in about 100,000 is taken for one of the file's.
BITS_PER_KEY = 24
BITS_SET = 16
# So many received keys at most are sent to the Bloom filters. More would be found in nearly every filter by
# mistake; the key columns are then read straight away.
MAX_PROBES = 20_000
# Files of a partition that are more and smaller than this are put together when they are written anew.
FILES_OF_PARTITION = 4
SMALL_FILE_ROWS = 100_000
ATTEMPTS = 5


class ConcurrentUpdate(RuntimeError):
    """Others published the next snapshot first, again and again."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    schema: T.StructType
    keys: tuple[str, ...]
    partitions: tuple[str, ...]
    listed: str
    notes: Mapping[str, object] = field(default_factory=dict)


def _folder(path: str, *parts: str) -> str:
    return "/".join([path.rstrip("/"), *parts])


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def is_logged(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, _folder(path, "log"))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the snapshots that can be read, oldest first."""
    if not is_logged(spark, path):
        return []
    fs, log = _file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path(_folder(path, "log"))
    names = [status.getPath().getName() for status in fs.listStatus(log)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """A snapshot by its number, or the newest; None if there is none."""
    known = versions(spark, path)
    if not known:
        return None
    number = known[-1] if version is None else version
    if number not in known:
        raise ValueError(f"{path} has no snapshot {number}")
    entry = json.loads(spark.read.text(_log_file(path, number), wholetext=True).first().value)
    schema = T.StructType.fromJson(entry["schema"])
    return Snapshot(number, schema, tuple(entry["keys"]), tuple(entry["partitions"]), entry["listed"], entry["notes"])


def _log_file(path: str, version: int) -> str:
    return _folder(path, "log", f"{version:020d}.json")


def _publish(spark: SparkSession, path: str, new: Snapshot) -> bool:
    """Make a snapshot visible; False if its number is taken."""
    fs, hadoop = _file_system(spark, path), spark._jvm.org.apache.hadoop.fs
    entry = {"schema": json.loads(new.schema.json()), "keys": new.keys, "partitions": new.partitions, "listed": new.listed, "notes": dict(new.notes)}
    draft = fs.makeQualified(hadoop.Path(_folder(path, "log", f".{uuid.uuid4().hex}.draft")))
    final = fs.makeQualified(hadoop.Path(_log_file(path, new.version)))
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(draft, final, no_options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if not fs.exists(final):
            raise error
        return False
    return True


def listed_files(spark: SparkSession, path: str, of: Snapshot) -> DataFrame:
    """``file, commit, rows, part, low, high`` for every file of a snapshot."""
    return spark.read.parquet(_folder(path, "files", of.listed))


def _names(files: DataFrame) -> list[str]:
    """As many as the table has files, which a plan that scans it holds as well."""
    return [r.file for r in files.select("file").collect()]


def _scan(spark: SparkSession, path: str, names: Sequence[str], schema: T.StructType) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    # Folder names are no columns here.
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[_folder(path, "data", n) for n in names])


def read(spark: SparkSession, path: str, within: Column | None = None, version: int | None = None) -> DataFrame:
    """A snapshot's rows. ``within``, a condition on partition columns alone, leaves out files and not rows of a file."""
    of = snapshot(spark, path, version)
    if of is None:
        raise FileNotFoundError(f"no table at {path}")
    files = listed_files(spark, path, of)
    if within is not None and of.partitions:
        # A file whose rows are of several partitions says nothing about them.
        known = files.select(F.col("file").alias("_file"), F.col("part").alias("_part"), "part.*")
        files = known.filter(F.col("_part").isNull() | within).withColumnRenamed("_file", "file")
    return _scan(spark, path, _names(files), of.schema)


def _complete(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _file_name() -> Column:
    return F.substring_index(F.input_file_name(), "/data/", -1)


def _write_rows(rows: DataFrame, path: str, folder: str, partitions: Sequence[str], spread: bool = True) -> int:
    """Rows to a new folder below ``data``, the files of a partition apart; returns how many.

    The folder of a partition is named by a hash: any value can have one. Without ``spread`` a task writes the rows it has.
    """
    counted = Observation()
    out = (spread_for_write(rows, partitions) if partitions and spread else rows).observe(counted, F.count(F.lit(1)).alias("rows"))
    target = _folder(path, "data", folder)
    if partitions:
        out.withColumn("_apart", F.xxhash64(*partitions)).write.mode("append").options(**DATA_OPTIONS).partitionBy("_apart").parquet(target)
    else:
        out.write.mode("append").options(**DATA_OPTIONS).parquet(target)
    return counted.get["rows"]


def _describe(spark: SparkSession, path: str, commit: str, what: str, of: Snapshot, rows: int) -> DataFrame:
    """The files a commit received, or kept, as rows of a list of files; their Bloom filters are written on the way.

    One pass over key and partition columns alone: a task sums its part of a file up, parts of one file are put together.
    """
    written = _scan(spark, path, [f"{commit}/{what}"], of.schema)
    part = F.struct(*of.partitions) if of.partitions else F.struct(F.lit(0).alias("_"))
    keyed = written.select(
        _file_name().alias("file"), F.when(_complete(of.keys), _key_hash(of.keys)).alias("h"), part.alias("part"), F.struct(*of.keys).alias("key")
    )
    files = max(1, len(written.inputFiles()))
    bits = 1 << max(10, min(27, (rows * BITS_PER_KEY // files).bit_length()))
    parts = keyed.mapInArrow(_summed_up(bits), _PARTS.format(part=keyed.schema["part"].dataType.simpleString(), key=keyed.schema["key"].dataType.simpleString()))
    both = parts.groupBy("file").agg(
        F.lit(commit).alias("commit"),
        F.sum("rows").alias("rows"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.struct(*[F.min(F.col("low")[k]).alias(k) for k in of.keys]).alias("low"),
        F.struct(*[F.max(F.col("high")[k]).alias(k) for k in of.keys]).alias("high"),
        F.pandas_udf(_any_bit, T.BinaryType())(F.collect_list("bloom")).alias("bloom"),
    )
    target = _folder(path, "blooms", commit, what)
    both.write.parquet(target)
    # Two partitions whose names collide share a file, which is then of no partition.
    one = F.when(F.col("first").eqNullSafe(F.col("last")), F.col("first"))
    return spark.read.parquet(target).select("file", "commit", "rows", one.alias("part"), "low", "high")


_PARTS = "file string, rows long, first {part}, last {part}, low {key}, high {key}, bloom binary"


def _summed_up(bits: int):
    """Sums up consecutive rows of a file: their number, first and last partition, ranges of the keys, bits of the keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rows, ends, flags = None, 0, {}, None

        def row() -> pa.RecordBatch:
            columns = [pa.array([name]), pa.array([rows], pa.int64()), *[ends[c] for c in ("first", "last", "low", "high")]]
            bloom = pa.array([np.packbits(flags).tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays([*columns, bloom], ["file", "rows", "first", "last", "low", "high", "bloom"])

        for batch in batches:
            file = batch.column("file")
            # A task reads its files one after the other.
            for run in file.unique().to_pylist():
                own = batch.filter(pc.equal(file, run))
                if run != name:
                    if name is not None:
                        yield row()
                    name, rows, ends, flags = run, 0, {}, np.zeros(bits, bool)
                rows += own.num_rows
                for column, kinds in (("part", ("first", "last")), ("key", ("low", "high"))):
                    for i, kind in enumerate(kinds):
                        now = _extreme(own.column(column), i, column == "part")
                        ends[kind] = now if kind not in ends else _extreme(pa.concat_arrays([ends[kind], now]), i, column == "part")
                hashes = own.column("h").drop_null().to_numpy()
                for places in bloom_places(hashes, bits):
                    flags[places] = True
        if name is not None:
            yield row()

    return work


def _extreme(values: pa.StructArray, which: int, null_first: bool) -> pa.StructArray:
    """A struct of one row: of every field the smallest (0) or greatest (1) value.

    Nulls do not count, unless they come first: then one is the smallest. NaN is greater than all numbers, as in SQL.
    """
    ends = []
    for i, field in enumerate(values.type):
        column = values.field(i)
        end = pc.min_max(column)[which].as_py()
        if which == 0 and null_first and column.null_count:
            end = None
        if which == 1 and pa.types.is_floating(field.type) and pc.any(pc.is_nan(column)).as_py():
            end = float("nan")
        ends.append(pa.array([end], field.type))
    return pa.StructArray.from_arrays(ends, fields=list(values.type))


def _any_bit(filters: pd.Series) -> pd.Series:
    return filters.map(lambda parts: bytes(parts[0]) if len(parts) == 1 else np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in parts]).tobytes())


def bloom_places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of each key, one array for each of the bits set for it."""
    first = hashes.astype(np.uint64)
    step = (first >> np.uint64(17) | first << np.uint64(47)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    for _ in range(BITS_SET):
        yield (first ^ first >> np.uint64(32)) % np.uint64(bits)
        first = first + step


def _probed(spark: SparkSession, path: str, files: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Of the files those whose Bloom filter knows one of the keys; ``hashes`` is at most ``MAX_PROBES`` long."""
    commits = [r.commit for r in files.select("commit").distinct().collect()]
    kept = [_folder(path, "blooms", c) for c in commits if table_exists(spark, _folder(path, "blooms", c))]
    if not kept:
        return files.limit(0)

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hit = []
            for bloom in batch["bloom"]:
                flags = np.frombuffer(bloom, np.uint8)
                alive = np.ones(len(hashes), bool)
                for at in bloom_places(hashes, len(flags) * 8):
                    alive &= (flags[at >> np.uint64(3)] >> (7 - (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                    if not alive.any():
                        break
                hit.append(bool(alive.any()))
            yield batch.loc[hit, ["file"]]

    filters = spark.read.schema("file string, bloom binary").option("recursiveFileLookup", "true").parquet(*kept)
    known = filters.mapInPandas(test, "file string")
    return files.join(known, "file", "left_semi")


def _candidates(spark: SparkSession, path: str, of: Snapshot, received: DataFrame, keys_fix_partition: bool) -> DataFrame:
    """Files that may hold a received key, by what the list of files and the Bloom filters tell."""
    files = listed_files(spark, path, of)
    if keys_fix_partition and of.partitions:
        parts = received.select(F.struct(*of.partitions).alias("_part")).distinct()
        of_received = files.join(parts, F.col("part").eqNullSafe(F.col("_part")), "left_semi")
        files = files.filter("part IS NULL").unionByName(of_received)
    complete = received.filter(_complete(of.keys))
    measured = complete.agg(
        F.count(F.lit(1)).alias("n"),
        F.struct(*[F.min(k).alias(k) for k in of.keys]).alias("low"),
        F.struct(*[F.max(k).alias(k) for k in of.keys]).alias("high"),
    )
    found = measured.first()
    if found.n == 0:
        return files.limit(0)
    # One row, back as a table so that its values keep their types.
    bounds = spark.createDataFrame([found], measured.schema).select(F.struct("low", "high").alias("b"))
    beyond = [(F.col("low")[k] <= F.col("_received.high")[k]) & (F.col("high")[k] >= F.col("_received.low")[k]) for k in of.keys]
    files = files.withColumn("_received", bounds.scalar()).filter(reduce(Column.__and__, beyond)).drop("_received")
    if found.n > MAX_PROBES:
        return files
    hashes = np.array([r.h for r in complete.select(_key_hash(of.keys).alias("h")).distinct().collect()], np.int64)
    return _probed(spark, path, files, hashes)


def _replaced_rows(received: DataFrame, spark: SparkSession, path: str, commit: str, of: Snapshot, keys_fix_partition: bool) -> DataFrame | None:
    """``file, bits`` for every file with a received key: a bit for each of its rows, set where the row is replaced."""
    names = _names(_candidates(spark, path, of, received, keys_fix_partition))
    if not names:
        return None
    # File and row in one number: the table's rows travel as that and a digest of their key.
    numbers = spark.createDataFrame(list(enumerate(names)), f"_number long, {_FILE} string")
    place = F.shiftleft("_number", _ROW_BITS).bitwiseOR(F.col(_ROW)).alias("_place")
    held = _placed(_scan(spark, path, names, of.schema)).filter(_complete(of.keys)).join(F.broadcast(numbers), _FILE)
    keys = received.filter(_complete(of.keys)).select(*key_digest(of.keys))
    hit = held.select(*key_digest(of.keys), place).join(keys, keys.columns, "left_semi")
    # A row for each file; a list is no longer than the file.
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    listed = hit.groupBy(F.shiftright("_place", _ROW_BITS).alias("_number")).agg(F.collect_list(row).alias("places"))
    target = _folder(path, "replaced", commit)
    listed.join(F.broadcast(numbers), "_number").select(F.col(_FILE).alias("file"), row_bits("places").alias("bits")).write.parquet(target)
    return spark.read.schema("file string, bits array<long>").parquet(target)


# A file has fewer rows than 2 to this power.
_ROW_BITS = 36
_FILE, _ROW = "_place_file", "_place_row"


def _placed(rows: DataFrame) -> DataFrame:
    """The rows of a scan with their file and their number in it."""
    return rows.withColumns({_FILE: _file_name(), _ROW: rows.metadataColumn("_metadata")["row_index"]})


def _write_kept(spark: SparkSession, path: str, folder: str, of: Snapshot, touched: DataFrame, replaced: DataFrame) -> int:
    """The rows of the touched files that are not replaced, to a new folder below ``data``; returns how many."""
    files = touched.select("file", "rows", "part").collect()
    crowded = len(files) > FILES_OF_PARTITION * len({str(r.part) for r in files}) and sum(r.rows for r in files) < SMALL_FILE_ROWS * len(files)
    together, rows = [[]], 0
    for file in sorted(files, key=lambda r: (str(r.part), r.file)):
        rows += file.rows
        if together[-1] and rows > ROWS_AT_ONCE:
            together.append([])
            rows = file.rows
        together[-1].append(file.file)
    left = 0
    for names in together:
        bits = replaced.filter(F.col("file").isin(names)).select(F.col("file").alias("_of_file"), F.col("bits").alias("_of_rows"))
        gone = (F.col(_FILE) == F.col("_of_file")) & has_bit("_of_rows", _ROW)
        stay = _placed(_scan(spark, path, names, of.schema)).join(F.broadcast(bits), gone, "left_anti")
        left += _write_rows(stay.select(*of.schema.names), path, folder, of.partitions, spread=crowded)
    return left


def _merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns, then those that are new. A column keeps its type."""
    known = {f.name: f for f in old}
    for f in new:
        if f.name in known and known[f.name].dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()} in the table and {f.dataType.simpleString()} in the rows received")
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in [*old, *[f for f in new if f.name not in known]]])


def merge(
    source: DataFrame,
    path: str,
    keys: Sequence[str] = ("merge_key",),
    newest: Sequence[str | Column] | None = None,
    partitions: Sequence[str] = PARTITIONS,
    keys_fix_partition: bool = False,
    replace: bool = False,
    notes: Mapping[str, object] | None = None,
    lies_apart: bool = False,
) -> int:
    """Update rows of the table whose key is in ``source``, insert the others; returns the number of the new snapshot.

    ``newest`` orders the copies of a key in the source; without it a key that comes twice is an error, found before
    anything becomes visible. Rows with a null in the key match nothing and are inserted. With ``keys_fix_partition`` a key
    never changes its partition, so only files of the partitions received are looked at. No rows make no
    snapshot. Columns may be added; one whose type differs from the table's is an error. With ``lies_apart`` a task has rows of few
    partitions, as where they are read from a table of the same partitions: they are written without a shuffle.
    """
    spark, commit = source.sparkSession, f"commit-{uuid.uuid4().hex}"
    unique = source if newest is None else newest_per_key(source, keys, newest)
    try:
        rows = _write_rows(unique, path, f"{commit}/received", partitions, spread=not lies_apart)
        received = _scan(spark, path, [f"{commit}/received"], source.schema)
        if newest is None:
            refuse_repeated_keys(received, keys)
        return _merge_received(spark, received, rows, path, commit, tuple(keys), tuple(partitions), keys_fix_partition, replace, notes)
    except Exception:
        for kind in ("data", "blooms", "files", "replaced"):
            delete_folder(spark, _folder(path, kind, commit))
        raise


def _merge_received(
    spark: SparkSession, received: DataFrame, rows: int, path: str, commit: str, keys: tuple, partitions: tuple,
    keys_fix_partition: bool, replace: bool, notes: Mapping[str, object] | None,
) -> int:
    own = Snapshot(0, _merged_schema(T.StructType([]), received.schema), keys, partitions, commit, notes or {})
    # What was received is described while the files it touches are looked for.
    with ThreadPoolExecutor(1) as pool:
        described = pool.submit(_describe, spark, path, commit, "received", own, rows)
        for _ in range(ATTEMPTS):
            before = snapshot(spark, path)
            if before is None:
                after, listed = own, described.result()
            elif rows == 0 and notes is None and not replace:
                return before.version
            else:
                if (before.keys, before.partitions) != (keys, partitions):
                    raise ValueError(f"{path} has keys {before.keys} and partitions {before.partitions}, not {keys} and {partitions}")
                schema = own.schema if replace else _merged_schema(before.schema, received.schema)
                after = Snapshot(before.version + 1, schema, keys, partitions, commit, before.notes if notes is None else notes)
                listed = listed_files(spark, path, before)
                replaced = None if replace else _replaced_rows(received, spark, path, commit, before, keys_fix_partition)
                if replace:
                    listed = listed.limit(0)
                if replaced is not None:
                    touched = listed.join(replaced.select("file"), "file", "left_semi")
                    if not touched.isEmpty():
                        left = _write_kept(spark, path, f"{commit}/kept", before, touched, replaced)
                        kept = _describe(spark, path, commit, "kept", after, left)
                        listed = listed.join(replaced.select("file"), "file", "left_anti").unionByName(kept)
                listed = listed.unionByName(described.result())
            listed.hint("rebalance").write.parquet(_folder(path, "files", commit))
            delete_folder(spark, _folder(path, "replaced", commit))
            if _publish(spark, path, after):
                return after.version
            # Another update came first: what was received stays, the rest is done again on what it left.
            for name in (_folder(path, "data", commit, "kept"), _folder(path, "blooms", commit, "kept"), _folder(path, "files", commit)):
                delete_folder(spark, name)
    raise ConcurrentUpdate(f"{ATTEMPTS} times another update of {path} was faster")


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Give up all but the newest ``keep`` snapshots and delete the files only those had; returns how many files.

    Updates that are under way are left alone: only what an expired snapshot lists is deleted.
    """
    known = versions(spark, path)
    gone, left = known[:-keep], known[-keep:]
    if not gone:
        return 0

    def files_of(numbers: list[int]) -> DataFrame:
        return reduce(DataFrame.unionByName, [listed_files(spark, path, snapshot(spark, path, n)).select("file") for n in numbers])

    unused = _names(files_of(gone).distinct().join(files_of(left), "file", "left_anti"))
    for number in gone:
        delete_folder(spark, _log_file(path, number))
    for name in unused:
        delete_folder(spark, _folder(path, "data", name))
    return len(unused)
