"""A training corpus from raw documents: five stages, each an operator of ``ridelake.llm``.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and is written as Parquet
before the next one reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import bbit, langid, packing, pfair, surrogates
from ridelake.llm.shared import stored
from ridelake.llm.tokens import vocabulary_path

# A text without a letter has no language; below this calibrated probability, none of those known.
LEAST_SCORE = 0.3
SURROGATE_KEY = "corpus"
# So many rows of the mixture fill sequences of their own.
SPAN_ROWS = 4_000
# Texts that go to a Python worker at once; a session's 10,000 are tens of megabytes, held by Spark and by the worker.
TEXTS_AT_ONCE = 1_000


def in_small_batches(spark: SparkSession) -> None:
    """The session's Arrow batches hold at most ``TEXTS_AT_ONCE`` rows from here on."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    spark.conf.set(name, str(min(now, TEXTS_AT_ONCE) if now > 0 else TEXTS_AT_ONCE))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go; ``lang`` becomes the language found in the others."""
    in_small_batches(spark)
    judged = langid.train_and_identify(docs).where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return judged.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    in_small_batches(spark)
    groups = bbit.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(groups, docs["doc_id"].eqNullSafe(groups["_kept_id"]), "left_semi")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    changed = surrogates.pseudonymise(docs, key=SURROGATE_KEY)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in the order of the mixture, which packing follows."""
    return pfair.in_order(pfair.mix(docs)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences follow the order that the mixture laid the documents out in."""
    in_small_batches(spark)
    return packing.pack_in_order(docs, path=vocabulary_path("byte_bpe_50k.json"), span_rows=SPAN_ROWS).drop("ids")


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("PII", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Trained models and keyed surrogates are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return stored(STAGES[-1][1](spark, docs, sf_dir), "stage")
