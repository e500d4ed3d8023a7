"""Responses landed as files, read back, and listed as raw documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.operators.storage import first_responses, raw_documents, read_table, write_batch
from lodegate.plans.identities import RESPONSES
from lodegate.plans.registry import derive, plain, query
from lodegate.session import scratch_path
from lodegate.sources.landing import land, landed

# The second run answers a day later, with the same bodies for two of three pages.
RUNS = f"""
SELECT 1 AS run, * FROM ({RESPONSES})
UNION ALL
SELECT 2, page_id, url, CASE WHEN page_id % 3 = 0 THEN html || '<!-- edited -->' ELSE html END, source_id, content_type,
  retrieved_at + INTERVAL '24' HOUR FROM ({RESPONSES})
"""


@query(f"""
WITH raw AS ({plain(RUNS)}),
links AS (SELECT *, 'https://' || regexp_extract(url, '^https?://([^/]*)', 1)
    || rtrim(regexp_extract(url, '^https?://[^/]*([^?#]*)', 1), '/')
    || CASE WHEN url LIKE '%?page=2&ref=x%' THEN '?page=2&ref=x' ELSE '' END AS canonical_url, sha256(html) AS content_hash FROM raw),
ids AS (SELECT *, sha256(source_id || chr(31) || canonical_url || chr(31) || content_hash) AS raw_document_id FROM links)
SELECT raw_document_id, min(run) AS batch, count(*) AS n_responses, any_value(content_hash) AS body_sha256,
  CAST(any_value(octet_length(encode(html))) AS BIGINT) AS body_bytes,
  strftime(min(retrieved_at), '%Y-%m-%d %H') AS first_hour
FROM ids WHERE canonical_url IS NOT NULL AND html IS NOT NULL GROUP BY raw_document_id""")
def landed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs land their responses; the second batch of raw documents is written twice and counts once."""
    root = scratch_path(spark, "landed")
    responses = derive(spark, folder, RUNS).filter(F.col("html").isNotNull()).select(
        "run", "source_id", F.col("url").alias("request_url"), F.col("url").alias("response_url"), F.lit(200).alias("status_code"),
        F.when(F.col("content_type").isNotNull(), F.create_map(F.lit("content-type"), "content_type")).otherwise(F.create_map().cast("map<string,string>")).alias("headers"),
        F.col("html").cast("binary").alias("body"), F.col("retrieved_at").cast("timestamp").alias("retrieved_at"),
    )
    table = f"{root}/documents"
    for run in (1, 2):
        land(raw_documents(responses.filter(F.col("run") == run).drop("run")), root)
    for run in (1, 2, 2):
        write_batch(first_responses(landed(spark, root, bodies=False, run=run)), table, run, "raw_document_id")
    bodies = landed(spark, root).filter(F.col("source_id") == "pages").select("raw_document_id", F.sha2("body", 256).alias("hash"), F.octet_length("body").alias("size"))
    found = bodies.groupBy("raw_document_id").agg(
        F.count(F.lit(1)).alias("n_responses"), F.min("hash").alias("body_sha256"), F.min("size").cast("long").alias("body_bytes")
    )
    return read_table(spark, table).join(found, "raw_document_id").select(
        "raw_document_id", F.col("batch").cast("int").alias("batch"), "n_responses", "body_sha256", "body_bytes",
        F.date_format("retrieved_at", "yyyy-MM-dd HH").alias("first_hour"),
    )
