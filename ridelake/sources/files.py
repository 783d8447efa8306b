"""Folders of tables, and what every way of writing one shares."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PARTITIONS = ("year", "month")

# Keys in hexadecimal, which other codecs leave as long as they are, take half the room.
DATA_OPTIONS = {"compression": "zstd"}

# Rows of files are marked together up to so many: with a bit for each, 16 MB are broadcast.
ROWS_AT_ONCE = 1 << 27


def table_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def spread_for_write(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """A rebalance by partition values: adaptive execution merges small and splits large ones."""
    return df.hint("rebalance", *[F.col(p) for p in partitions])


def newest_per_key(source: DataFrame, keys: Sequence[str], newest: Sequence[str | Column]) -> DataFrame:
    """One row per key; rows with a null in the key match nothing and all stay."""
    complete = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in newest]
    ties = [F.col(c).asc_nulls_first() for c in source.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    single = source.filter(complete).withColumn("_copy", F.row_number().over(window)).filter("_copy = 1")
    return single.drop("_copy").unionByName(source.filter(~complete))


def refuse_repeated_keys(rows: DataFrame, keys: Sequence[str]) -> None:
    """Keys are counted by a hash; only those whose hash comes twice travel whole."""
    complete = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    hashed = rows.filter(complete).select(*keys, F.xxhash64(*keys).alias("_hash"))
    twice = hashed.groupBy("_hash").count().filter("count > 1").select("_hash")
    if twice.isEmpty():
        return
    repeated = hashed.join(twice, "_hash", "left_semi").groupBy(*keys).count().filter("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"a key ({', '.join(keys)}) comes more than once; say with newest= which row counts")


def key_digest(keys: Sequence[str]) -> list[Column]:
    """What stands for a key where many are compared: 96 bits by two kinds of hash, however long the key is."""
    return [F.xxhash64(*keys).alias("_digest_64"), F.hash(*keys).alias("_digest_32")]


def row_bits(places: str) -> Column:
    """A bit for each row of a file up to the last one listed, set for those listed."""
    return F.pandas_udf(_as_bits, "array<long>")(places)


def _as_bits(places: pd.Series) -> pd.Series:
    def bits(of_file: np.ndarray) -> np.ndarray:
        flags = np.zeros((int(of_file.max()) // 64 + 1) * 64, bool)
        flags[of_file] = True
        return np.packbits(flags, bitorder="little").view("<i8")

    return places.map(bits)


def has_bit(bits: str | Column, place: str | Column) -> Column:
    """Whether the bit at a place is set; places beyond the last are not."""
    word = F.get(bits, F.shiftright(place, 6).cast("int"))
    return F.coalesce(F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1, F.lit(False))
