"""Writing: partitioned tables, gold tables, CSV, and upsert of plain folders (``table_log`` has the one with snapshots)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException, UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.operators.counting import StageCounts
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
from ridelake.sources.tables import CSV_OPTIONS


def sink_partitioned(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partitions: Sequence[str] = PARTITIONS,
    counts: StageCounts | None = None,
    stage: str = "written",
) -> bool:
    """Write by partition; nothing is written for no rows. Returns whether rows were written.

    ``counts`` counts the rows on their way out, under the name ``stage``.
    """
    if df.isEmpty():
        return False
    if counts is not None:
        df = counts.mark(df, stage)
    spread_for_write(df, partitions).write.options(**DATA_OPTIONS).mode(mode).partitionBy(*partitions).parquet(path)
    return True


def sink_gold(tables: Mapping[str, DataFrame | None], base: str, mode: str = "overwrite") -> dict[str, bool]:
    """Write each gold table below ``base``; one that is absent or empty is left alone.

    A gold table is small against what it is made from: it is computed once, kept, looked at and written.
    """
    written = {}
    for name, table in tables.items():
        kept = None if table is None else table.persist()
        written[name] = kept is not None and not kept.isEmpty()
        if written[name]:
            kept.write.mode(mode).parquet(f"{base.rstrip('/')}/{name}")
        if kept is not None:
            kept.unpersist()
    return written


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def upsert(
    source: DataFrame,
    path: str,
    keys: Sequence[str] = ("merge_key",),
    newest: Sequence[str | Column] | None = None,
    partitions: Sequence[str] = PARTITIONS,
    keys_fix_partition: bool = False,
) -> None:
    """Update rows of the table whose key is in ``source``, insert the others.

    ``newest`` orders the copies of a key in the source; without it a key that comes twice is an
    error, found before anything is written. With ``keys_fix_partition`` a key never changes its
    partition, so only the partitions that receive rows are read.

    Copy on write over partitioned Parquet: only partitions that receive rows, or that hold
    an old row of a received key, are rewritten. Their new content is completed in a hidden
    folder of the table before the first old file goes, and its files are then renamed. What is interrupted later is
    taken up by the next ``upsert``, or by ``finish_upsert``: the swap can be repeated as often as needed.

    Rows received are shuffled to their partition and written once. Replaced rows are found by file and place, from key
    columns alone, compared by 96 bits of hashes; rows that stay are filtered where they are read.
    """
    spark = source.sparkSession
    finish_upsert(spark, path)
    pending, old = _pending(path), None
    unique = source if newest is None else newest_per_key(source, keys, newest)
    if _holds_files(spark, path):
        old = _typed_like(source, spark.read.option("mergeSchema", "true").parquet(path), path, partitions)
        unique = _with_columns_of(old.unionByName(source, allowMissingColumns=True), unique)
    try:
        _add_content(spread_for_write(unique, partitions), path, partitions)
        incoming = spark.read.schema(unique.schema).parquet(f"{pending}/content")
        if newest is None:
            refuse_repeated_keys(incoming, keys)
        filled = _partition_values(incoming, partitions)
        if filled:
            folders = [] if old is None else _add_kept(old, incoming, path, keys, partitions, filled, keys_fix_partition)
            _write_plan(spark, path, folders)
    except Exception:
        delete_folder(spark, pending)
        _delete_if_empty(spark, path)
        raise
    finish_upsert(spark, path)
    _delete_if_empty(spark, path)


# Files of a partition that are more and smaller than this are put together when it is rewritten.
FILES_OF_PARTITION = 4
SMALL_FILE_BYTES = 8 << 20

_FILE, _ROW = "_place_file", "_place_row"


def _add_content(rows: DataFrame, path: str, partitions: Sequence[str]) -> None:
    rows.write.mode("append").options(**DATA_OPTIONS).partitionBy(*partitions).parquet(f"{_pending(path)}/content")


def _with_columns_of(like: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.sparkSession.createDataFrame([], like.schema).unionByName(rows, allowMissingColumns=True)


def _add_kept(
    old: DataFrame, incoming: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str], filled: set[tuple], keys_fix_partition: bool
) -> list[str]:
    """Add the rows that stay in the partitions to be rewritten; returns the folders of those that have none left.

    Replaced rows are a bit for each row of their file, so those that stay are not shuffled.
    """
    spark, pending, found = old.sparkSession, _pending(path), old.metadataColumn("_metadata")
    target = old.withColumns({_FILE: F.xxhash64(found["file_path"]), _ROW: found["row_index"]})
    # Equal values of two types hash apart: then whole keys are compared.
    alike = all(target.schema[k].dataType == incoming.schema[k].dataType for k in keys)
    by = [c.alias(f"_key_{i}") for i, c in enumerate(key_digest(keys) if alike else map(F.col, keys))]
    complete = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    received = incoming.filter(complete).select(*by)
    looked_at = target.filter(_is_one_of(filled, partitions)) if keys_fix_partition else target
    hit = looked_at.filter(complete).select(*by, *partitions, _FILE, _ROW).join(received, received.columns, "left_semi")
    listed = hit.groupBy(_FILE, *partitions).agg(F.collect_list(_ROW).alias("places"))
    listed.select(F.col(_FILE).alias("_of_file"), *partitions, row_bits("places").alias("_of_rows")).write.parquet(f"{pending}/replaced")
    replaced = spark.read.parquet(f"{pending}/replaced")
    marked = replaced.groupBy(*partitions).agg((F.sum(F.size("_of_rows")) * 64).alias("n")).collect()
    marks = {tuple(row)[:-1]: row.n for row in marked}
    crowded = _crowded(spark, path)
    for some in _together(filled | marks.keys(), marks):
        rows, bits = (df.filter(_is_one_of(some, partitions)) for df in (target, replaced))
        gone = (F.col(_FILE) == F.col("_of_file")) & has_bit("_of_rows", _ROW)
        stay = rows.join(F.broadcast(bits.select("_of_file", "_of_rows")), gone, "left_anti").drop(_FILE, _ROW)
        stay = _with_columns_of(incoming, stay)
        _add_content(spread_for_write(stay, partitions) if crowded else stay, path, partitions)
    # Partitions that lost their last row.
    emptied = marks.keys() - filled
    if emptied:
        content = spark.read.schema(incoming.schema).parquet(f"{pending}/content")
        emptied = emptied - _partition_values(content.filter(_is_one_of(emptied, partitions)), partitions)
    return _folders_of(old.filter(_is_one_of(emptied, partitions))) if emptied else []


def _together(values: set[tuple], marks: Mapping[tuple, int]) -> list[set[tuple]]:
    """The partitions in groups of which each marks as many rows as are broadcast at once."""
    groups, n = [set()], 0
    for value in sorted(values, key=str):
        n += marks.get(value, 0)
        if groups[-1] and n > ROWS_AT_ONCE:
            groups.append(set())
            n = marks.get(value, 0)
        groups[-1].add(value)
    return groups


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}/_pending_upsert"


def _files_below(spark: SparkSession, folder: str) -> list[tuple[str, str, int]]:
    """Folder below ``folder``, name and bytes of each data file."""
    fs, root = _file_system(spark, folder)
    top, found, listed = fs.makeQualified(root).toString(), [], fs.listFiles(root, True)
    while listed.hasNext():
        status = listed.next()
        parts = status.getPath().toString()[len(top) :].strip("/").split("/")
        if not any(p.startswith(("_", ".")) for p in parts if "=" not in p):
            found.append(("/".join(parts[:-1]), parts[-1], status.getLen()))
    return found


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _holds_files(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, path) and bool(_files_below(spark, path))


def _delete_if_empty(spark: SparkSession, path: str) -> None:
    """No folder is left where there is no table."""
    fs, root = _file_system(spark, path)
    if fs.exists(root) and not len(fs.listStatus(root)):
        fs.delete(root, False)


def _crowded(spark: SparkSession, path: str) -> bool:
    files = _files_below(spark, path)
    folders = {folder for folder, _, _ in files}
    return len(files) > FILES_OF_PARTITION * len(folders) and sum(n for _, _, n in files) < SMALL_FILE_BYTES * len(files)


def _write_plan(spark: SparkSession, path: str, emptied: Sequence[str]) -> None:
    """The files to be moved in and the folders to be deleted; with it an upsert's content is complete."""
    moved = [(folder, name) for folder, name, _ in _files_below(spark, f"{_pending(path)}/content")]
    rows = [*moved, *[(folder, None) for folder in emptied]]
    spark.createDataFrame(rows, "folder string, file string").coalesce(1).write.parquet(f"{_pending(path)}/plan")


def finish_upsert(spark: SparkSession, path: str) -> bool:
    """Complete an upsert that was interrupted while it moved its content in; drop one that had none yet.

    Returns whether there was content to move.
    """
    pending = _pending(path)
    if not table_exists(spark, pending):
        return False
    complete = table_exists(spark, f"{pending}/plan/_SUCCESS")
    if complete:
        moved, emptied = {}, []
        for row in spark.read.schema("folder string, file string").parquet(f"{pending}/plan").collect():
            if row.file is None:
                emptied.append(row.folder)
            else:
                moved.setdefault(row.folder, []).append(row.file)
        for folder, names in moved.items():
            _move_in(spark, f"{pending}/content/{folder}", f"{path.rstrip('/')}/{folder}", names)
        for folder in emptied:
            delete_folder(spark, folder)
            if table_exists(spark, folder):
                raise RuntimeError(f"could not delete {folder}, whose rows have moved")
    delete_folder(spark, pending)
    return complete


def _move_in(spark: SparkSession, source: str, folder: str, names: Sequence[str]) -> None:
    """Give a partition its new files in place of all others; those that were moved before stay."""
    fs, target = _file_system(spark, folder)
    fs.mkdirs(target)
    for status in fs.listStatus(target):
        if status.isFile() and status.getPath().getName() not in names:
            fs.delete(status.getPath(), False)
    for name in names:
        new, final = (_file_system(spark, f"{at}/{name}")[1] for at in (source, folder))
        if fs.exists(new):
            fs.delete(final, False)
            if not fs.rename(new, final):
                raise RuntimeError(f"could not move {new} to {final}")
        elif not fs.exists(final):
            raise RuntimeError(f"{new} is lost")


def _partition_values(df: DataFrame, partitions: Sequence[str]) -> set[tuple]:
    """The partitions rows fall into: as many entries as the table has directories."""
    return {tuple(row) for row in df.select(*partitions).distinct().collect()}


def _is_one_of(values: set[tuple], partitions: Sequence[str]) -> Column:
    """Whether a row lies in one of the partitions; prunes the scan to them. Structs compare nulls as equal."""
    kinds = [F.struct(*[F.lit(v).alias(p) for p, v in zip(partitions, row)]) for row in sorted(values, key=str)]
    return F.struct(*partitions).isin(*kinds)


def _typed_like(rows: DataFrame, target: DataFrame, path: str, partitions: Sequence[str]) -> DataFrame:
    """The target read with the partition types of ``rows``, where folder names made it guess others."""
    kinds = {p: rows.schema[p].dataType for p in partitions}
    if all(target.schema[p].dataType == kind for p, kind in kinds.items()):
        return target
    fields = [T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in target.schema]
    return target.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def _folders_of(rows: DataFrame) -> list[str]:
    """The folders rows lie in, by the names they have and not by those they should have; one for each partition at most."""
    jvm = rows.sparkSession._jvm
    names = [r.f for r in rows.select(F.input_file_name().alias("f")).distinct().collect()]
    return sorted({jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)).getParent().toString() for name in names})


def changed_split(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Table content after an upsert, without writing: unmatched rows of the target, all of the source."""
    unmatched = target.join(source.select(*keys), list(keys), "left_anti")
    return unmatched.unionByName(source, allowMissingColumns=True)


def merge_into(spark: SparkSession, source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert by ``MERGE INTO``, for a table whose provider supports it.

    Plain Parquet does not; there this raises, and ``upsert`` is the way.
    """
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    try:
        spark.sql(
            f"MERGE INTO {table} t USING {{source}} s ON {match} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
            source=source,
        )
    except (AnalysisException, UnsupportedOperationException) as error:
        raise NotImplementedError(f"{table} does not support MERGE INTO; use upsert()") from error
