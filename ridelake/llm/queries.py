"""Registered queries of the numbered operators, and the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import anchors, bbit, centroids, compression, langid, nra, packing, pfair, quality, surrogates, vantage, warc, wavelet
from ridelake.llm.tokens import vocabulary_path
from ridelake.queries.registry import Query
from ridelake.session import scratch_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


# Words are runs of characters other than ASCII white space.
_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

REPEATS_SQL = f"""WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
  win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
  low AS (SELECT k, min(doc_id) AS lo FROM win GROUP BY k),
  gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN low USING (k) WHERE lo < doc_id),
  word AS (SELECT doc_id, p, ws[p] AS x FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)),
  kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

# Base 32 of a digest: four letters from each five hexadecimal digits.
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST(1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS BIGINT), 1)), '')"""

ARCHIVES_SQL = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
  f AS (SELECT html, min(page_id) AS original FROM p GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to FROM p JOIN f USING (html)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NEAR_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS ws FROM documents),
  s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS k
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, CASE WHEN len(ws) > 0 THEN 2 ELSE 1 END))) AS i FROM w)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
  e AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * m >= 80 * (x.n + y.n - m)),
  r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT r.a AS doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a"""


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
LEXICAL_SQL = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
  whole AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
  asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
  p AS MATERIALIZED (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
  w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, whole GROUP BY t),
  m AS (SELECT r, doc_id, 10 + (90 * len(ts) * n_docs) // n_terms AS m FROM d, whole),
  s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN p USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10"""


def _clustering_sql(rounds: int = 5, k: int = 40) -> str:
    """Unrolled rounds; floor division is spelled out, as integer division rounds towards zero."""
    floor = "(s - ((s % n) + n) % n) // n"
    whole = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"
    usable = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64"
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {whole} AS x FROM embeddings WHERE {usable})",
        f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INT) AS c, x FROM
          (SELECT sha256('2:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        # Squared distance by products, all of them exact.
        near = "list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, c.x) + list_dot_product(c.x, c.x)"
        near = near.replace("v.x", "CAST(v.x AS DOUBLE[])").replace("c.x", "CAST(c.x AS DOUBLE[])")
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT r, vec_id, x, c, d FROM (SELECT v.r, v.vec_id, v.x, c.c, CAST({near} AS BIGINT) AS d
              FROM v, c{i} c) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(y, c{i}.x) AS x FROM c{i} LEFT JOIN (SELECT c, list({floor} ORDER BY j) AS y FROM
                  (SELECT c, j, CAST(sum(e) AS BIGINT) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS e, unnest(range(64)) AS j FROM a{i}) GROUP BY c, j)
                  GROUP BY c) USING (c))"""
            )
    return f"""WITH {', '.join(parts)} SELECT vec_id, c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
      CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256,
      count(*) OVER (PARTITION BY c) AS cluster_size FROM a{rounds} JOIN c{rounds} USING (c)"""


CLUSTERING_SQL = _clustering_sql()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@register()
def op1_vantage_trees(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return vantage.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@register(ARCHIVES_SQL)
def op4_seekable_bundles(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, folder, "pages"), scratch_path(spark, "bundles")).drop("target_uri")


@register(NEAR_SQL)
def op10_bbit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return bbit.near_duplicates(table(spark, folder, "documents"), width=4)


@register(REPEATS_SQL)
def op2_block_anchors(spark: SparkSession, folder: str) -> DataFrame:
    cut = anchors.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


@register()
def op8_ftrl_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.train_and_identify(table(spark, folder, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@register()
def op9_pfair_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return pfair.mix(table(spark, folder, "documents")).select("doc_id", "source", "block", "slot", "place")


@register()
def op6_wavelet_matrix(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = vocabulary_path("word_bpe_49k.json")
    shards = wavelet.write_shards(table(spark, folder, "documents"), scratch_path(spark, "wavelet"), path=vocabulary)
    return wavelet.read_shards(shards)


@register()
def op7_minimum_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"), path=vocabulary_path("byte_bpe_50k.json"))
    return packed.drop("ids")


@register()
def op3_keyed_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.pseudonymise(table(spark, folder, "documents"), key="corpus").select("doc_id", "text", "n_entities")


@register()
def op5_risk_controlled_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register(LEXICAL_SQL)
def op11_nra_search(spark: SparkSession, folder: str) -> DataFrame:
    return nra.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@register()
def op12_dictionary_quality(spark: SparkSession, folder: str) -> DataFrame:
    scored = compression.train_and_score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@register(CLUSTERING_SQL)
def op13_subvector_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))
