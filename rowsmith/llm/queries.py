"""The named queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm import (
    bpe, divergence, embedding_dedup, exact_dedup, language_model, licenses, minhash, packing, quality, secrets, sharding, spelling, url_filter,
)
from rowsmith.queries.base import derive, table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        LLM_QUERIES[name] = fn
        if oracle is not None:
            LLM_ORACLES[name] = oracle
        return fn

    return wrap


@query(
    "op5_exact_dedup",
    r"""
    WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.annotate_copies(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op3_licenses", licenses.oracle())
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


# Captures and a dated list derived from the pages: hosts, their parent domains and first path segments
# come and go, on days that follow from the first page that names them.
CAPTURES = """
SELECT page_id, url, CAST(CAST('2020-01-01' AS DATE) + CAST(page_id % 730 AS INT) AS TIMESTAMP) AS fetched_at FROM {pages}
"""
LISTED = """
WITH seen AS (
  SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*/([^/?#]+)', 1) AS part
  FROM {pages}),
hosts AS (SELECT host AS value, min(page_id) AS m FROM seen GROUP BY host),
parents AS (SELECT regexp_replace(host, '^[^.]*[.]', '') AS value, min(page_id) AS m FROM seen GROUP BY 1),
parts AS (SELECT host || '/' || part AS value, min(page_id) AS m FROM seen WHERE part != '' GROUP BY 1),
days AS (
  SELECT 'domain' AS scope, value, 'add' AS action, (m * 7) % 300 AS day FROM hosts WHERE m % 3 = 0
  UNION ALL SELECT 'domain', value, 'remove', (m * 7) % 300 + 100 FROM hosts WHERE m % 3 = 0
  UNION ALL SELECT 'domain', value, 'add', (m * 7) % 300 + 200 FROM hosts WHERE m % 6 = 0
  UNION ALL SELECT 'domain', value, 'add', (m * 13) % 365 FROM parents WHERE m % 5 = 0
  UNION ALL SELECT 'prefix', value, 'add', (m * 11) % 365 FROM parts WHERE m % 4 = 1
  UNION ALL SELECT 'prefix', value, 'remove', (m * 11) % 365 + 50 FROM parts WHERE m % 8 = 1)
SELECT scope, value, action, CAST(CAST('2020-01-01' AS DATE) + CAST(day AS INT) AS TIMESTAMP) AS dated FROM days
"""


@query(
    "op9_url_filter",
    rf"""
    WITH captures AS ({CAPTURES.replace("{pages}", "pages")}), entries AS ({LISTED.replace("{pages}", "pages")}),
    states AS (SELECT scope, value, dated, max(action) AS action FROM entries GROUP BY ALL),
    spans AS (
      SELECT scope, value, dated AS since, lead(dated) OVER (PARTITION BY scope, value ORDER BY dated) AS until, action FROM states),
    parsed AS (
      SELECT page_id, fetched_at, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
             regexp_extract(url, '^[a-z]+://([^?#]*)', 1) AS plain FROM captures),
    hits AS (
      SELECT p.page_id, s.scope || ':' || s.value AS hit FROM parsed p JOIN spans s
        ON s.action = 'add' AND s.since <= p.fetched_at AND (s.until IS NULL OR p.fetched_at < s.until)
       AND ((s.scope = 'domain' AND (p.host = s.value OR ends_with(p.host, '.' || s.value)))
         OR (s.scope = 'prefix' AND (p.plain = s.value OR starts_with(p.plain, s.value || '/'))))),
    counted AS (SELECT page_id, count(*) AS n_hits, string_agg(hit, ' ' ORDER BY hit) AS hits FROM hits GROUP BY page_id)
    SELECT c.page_id, c.url, c.fetched_at, coalesce(n_hits, 0) AS n_hits, coalesce(hits, '') AS hits, n_hits IS NOT NULL AS blocked
    FROM captures c LEFT JOIN counted USING (page_id)
    """,
)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(derive(spark, sf_dir, CAPTURES, "pages"), derive(spark, sf_dir, LISTED, "pages"))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query("op1_secrets")
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query("op8_embedding_dedup")
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.annotate(table(spark, sf_dir, "embeddings"))


@query("op10_minhash")
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.annotate(table(spark, sf_dir, "documents"))


@query("op11_divergence", divergence.oracle())
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op12_language_model")
def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


@query("op13_spelling")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))
