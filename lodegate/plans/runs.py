"""Whole ingestion runs over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodegate.functions import identity
from lodegate.operators import ingest
from lodegate.operators.enrichment import read_articles
from lodegate.operators.export import write_csv
from lodegate.operators.freshness import reason_map
from lodegate.operators.storage import write_batch
from lodegate.plans.documents import (
    FEEDS,
    _FEED_ITEMS_SQL,
    _feed_documents,
    ARCHIVE_PAGES,
    ORGANIZATION_PAGES,
    PRODUCT_PAGES,
)
from lodegate.plans.entities import SEEDS
from lodegate.plans.identities import CANONICAL_SQL, canonical_urls
from lodegate.plans.records import _SHOWN
from lodegate.plans.registry import derive, plain, query, table
from lodegate.scale import first_per_key
from lodegate.session import materialize, scratch_path
from lodegate.sources import archive, directories, feeds
from lodegate.sources.tables import read_tabs


def _noon() -> Column:
    return F.lit("2024-01-05 12:00:00+00:00").cast("timestamp")


def _with_raw(rows: DataFrame, source_id: str, body: Column) -> DataFrame:
    """Raw document columns for rows that hold a landed body."""
    return rows.withColumns(
        {
            "source_id": F.lit(source_id),
            "content_hash": identity.content_hash(body),
            "retrieved_at": F.lit("2024-01-05 11:00:00+00:00").cast("timestamp"),
        }
    ).withColumn("raw_document_id", identity.record_id(F.col("source_id"), F.col("content_hash")))


@query(f"""
WITH {CANONICAL_SQL}, {_SHOWN},
firsts AS (SELECT canonical_url, min(url_id) AS url_id FROM canonical WHERE canonical_url IS NOT NULL GROUP BY canonical_url)
SELECT sha256('pages' || chr(31) || canonical_url) AS record_id, canonical_url, sha256(html) AS content_hash, nullif(s.title, '') AS title, sha256(s.body) AS body_hash
FROM firsts JOIN pages p ON p.page_id = url_id // 5 JOIN shown s ON s.page_id = p.page_id""")
def article_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every spelling of every page address, the first per canonical address, with its article."""
    urls = canonical_urls(spark, folder).withColumn("page_id", F.floor(F.col("url_id") / 5))
    first = first_per_key(urls, ["canonical_url"], "url_id")
    landed = first.join(table(spark, folder, "pages").select("page_id", "html"), "page_id")
    read = read_articles(landed, "html", F.lit(""), _noon())
    return read.select(
        identity.record_id(F.lit("pages"), F.col("canonical_url")).alias("record_id"),
        "canonical_url",
        identity.content_hash(F.col("html")).alias("content_hash"),
        F.col("article_title").alias("title"),
        F.sha2("article_body", 256).alias("body_hash"),
    )


_GATED = f"""{_FEED_ITEMS_SQL},
gated AS (SELECT *, CASE WHEN published_at IS NULL THEN 'date_unresolved' WHEN published_at > TIMESTAMP '2024-01-05 12:00:00' THEN 'future_date'
    WHEN published_at < TIMESTAMP '2024-01-04 12:00:00' THEN 'stale_date' ELSE 'fresh' END AS reason FROM items),
claims AS (SELECT *, reason = 'fresh' AND (item_position = 0 OR row_number() OVER (PARTITION BY reason, {{key}} ORDER BY o_orderkey) = 1) AS claimed FROM gated)
"""


def _feeds(spark: SparkSession, folder: str) -> DataFrame:
    documents = _feed_documents(spark, folder).withColumnRenamed("o_orderkey", "position")
    return _with_raw(documents, "shop_feed", F.col("body"))


@query(f"""WITH {_GATED.format(key='item_position')}
SELECT o_orderkey, item_position, reason, claimed FROM claims""")
def news_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Gate and claim of all feed items; second items share one text, so one key holds a third of the fresh rows."""
    decided = ingest.decide_feed(_feeds(spark, folder), "news", _noon())
    return decided.select(F.col("position").alias("o_orderkey"), "item_position", "decision.reason", "claimed")


@query(f"""WITH {_GATED.format(key='item_position')}, counted AS (
  SELECT reason, count(*) AS n FROM gated GROUP BY reason UNION ALL SELECT 'source_failure', count(*) FROM orders WHERE o_orderkey % 100 = 99)
SELECT 'shop_feed' AS source_id, string_agg(reason || '=' || n, ',' ORDER BY reason) AS reasons FROM counted WHERE n > 0""")
def feed_reason_map(spark: SparkSession, folder: str) -> DataFrame:
    """Reasons of all feed items, with the feeds that are no XML as source failures."""
    fed = materialize(feeds.parse_feeds(_feeds(spark, folder).select("source_id", "position", "body"), "body"), "parsed-feeds")
    decided = ingest.gate_feed(fed, "news", _noon()).select("source_id", "decision.reason")
    counted = reason_map(decided, "source_id", feeds.malformed_feeds(fed, "body"))
    shown = F.transform(F.map_entries("reasons"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return counted.select("source_id", F.array_join(shown, ",").alias("reasons"))


@query(f"""WITH {_GATED.format(key='item_position')}, found AS (SELECT count(*) AS discovered FROM orders), counted AS (
  SELECT count(*) AS parsed, count(*) FILTER (claimed) AS accepted, count(*) FILTER (reason IN ('future_date', 'stale_date')) AS rejected,
    count(*) FILTER (reason = 'date_unresolved') AS quarantined, count(*) FILTER (reason = 'fresh' AND NOT claimed) AS duplicates FROM claims)
SELECT s AS source_id, found.*, counted.* FROM found, counted, (VALUES ('shop_feed'), (NULL)) AS sources(s)""")
def feed_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The counters of a run over all feeds, those that are no XML among the discovered ones."""
    fed = _feeds(spark, folder)
    return ingest.feed_summary(ingest.decide_feed(fed, "news", _noon()), fed)


@query(f"""WITH {_GATED.format(key='item_position')}
SELECT sha256('shop_feed' || chr(31) || canonical_url) AS record_id, title, 'AI' AS category,
  (epoch_us(TIMESTAMP '2024-01-05 12:00:00') - epoch_us(published_at)) / 1000000.0::DOUBLE / 3600.0::DOUBLE AS age_hours, '' AS problems FROM claims WHERE claimed""")
def news_records(spark: SparkSession, folder: str) -> DataFrame:
    made = ingest.feed_records(ingest.decide_feed(_feeds(spark, folder), "news", _noon()), "news", _noon())
    field = lambda path: F.get_json_object("payload", path)
    return made.select(
        "record_id",
        field("$.content.title").alias("title"),
        field("$.content.category").alias("category"),
        field("$.freshness.ageHours").cast("double").alias("age_hours"),
        F.array_join("problems", ",").alias("problems"),
    )


# An article for the first item of every second order.
LANDED = """
SELECT 'http://shop.example.org/o/' || CAST(o_orderkey AS STRING) || '?utm_source=rss' AS original_url,
  '<html><head><title>Landed ' || CAST(o_orderkey AS STRING) || '</title></head><body><article><p>' || repeat('An article about the order. ', 20) || '</p></article></body></html>' AS html
FROM {orders} WHERE o_orderkey % 2 = 0
"""


@query(f"""WITH {_GATED.format(key='item_position')}, landed AS ({plain(LANDED)}), feed_texts AS ({plain(FEEDS)}),
made AS (SELECT c.canonical_url, CASE WHEN l.html IS NULL THEN 'feed' ELSE 'article' END AS made_from, CASE WHEN l.html IS NULL THEN c.title ELSE 'Landed ' || c.o_orderkey END AS title,
    sha256(coalesce(l.html, f.xml)) AS content_hash, CASE WHEN l.html IS NULL THEN 'shop_feed' ELSE 'shop_articles' END AS source
  FROM claims c JOIN feed_texts f USING (o_orderkey) LEFT JOIN landed l ON c.item_position = 0 AND l.original_url = 'http://shop.example.org/o/' || c.o_orderkey || '?utm_source=rss' WHERE claimed)
SELECT sha256('shop_feed' || chr(31) || canonical_url) AS record_id, title, content_hash, sha256(source || chr(31) || content_hash) AS raw_document_id,
  '["' || sha256(source || chr(31) || content_hash) || '"]' AS raw_document_ids,
  CASE made_from WHEN 'feed' THEN '2024-01-05T11:00:00.000000Z' ELSE '2024-01-05T11:30:00.000000Z' END AS retrieved_at, '' AS problems FROM made""")
def enriched_news_records(spark: SparkSession, folder: str) -> DataFrame:
    """News records of feeds and landed articles; a completed record names the article as its evidence."""
    pages = _with_raw(derive(spark, folder, LANDED), "shop_articles", F.col("html"))
    pages = pages.withColumn("retrieved_at", F.lit("2024-01-05 11:30:00+00:00").cast("timestamp"))
    decided = ingest.decide_feed(_feeds(spark, folder), "news", _noon())
    made = ingest.feed_records(decided, "news", _noon(), pages=pages)
    field = lambda path: F.get_json_object("payload", path)
    return made.select(
        "record_id",
        field("$.content.title").alias("title"),
        field("$.provenance.contentHash").alias("content_hash"),
        field("$.provenance.rawDocumentId").alias("raw_document_id"),
        field("$.provenance.extractionMetadata.raw_document_ids").alias("raw_document_ids"),
        field("$.provenance.retrievedAt").alias("retrieved_at"),
        F.array_join("problems", ",").alias("problems"),
    )


@query(f"""WITH {_GATED.format(key="item_position, coalesce(author, '')")}
SELECT sha256('shop_feed' || chr(31) || canonical_url) AS record_id, coalesce(author, 'Unknown company') AS company, (item_position = 0)::VARCHAR AS is_remote,
  CASE item_position WHEN 0 THEN 'Design' ELSE 'Research' END AS role_family, '' AS problems FROM claims WHERE claimed""")
def job_records(spark: SparkSession, folder: str) -> DataFrame:
    made = ingest.feed_records(ingest.decide_feed(_feeds(spark, folder), "job", _noon()), "job", _noon())
    field = lambda path: F.get_json_object("payload", path)
    return made.select(
        "record_id",
        field("$.content.company").alias("company"),
        field("$.content.isRemote").alias("is_remote"),
        field("$.content.roleFamily").alias("role_family"),
        F.array_join("problems", ",").alias("problems"),
    )


ARCHIVE_BIBLIOGRAPHY = """
SELECT CAST(CAST(2401 + floor(o_orderkey / 90000) AS BIGINT) AS STRING) || '.' || CAST(10000 + o_orderkey % 90000 AS STRING) AS arxiv_id, 'https://arxiv.org/abs/' || CAST(CAST(2401 + floor(o_orderkey / 90000) AS BIGINT) AS STRING) || '.' || CAST(10000 + o_orderkey % 90000 AS STRING) AS paper_url, 'Title ' || CAST(o_orderkey AS STRING) AS title,
  CAST(o_orderdate AS TIMESTAMP) AS published_at, o_orderpriority AS abstract FROM {orders} WHERE o_orderkey % 5 <> 0
"""
ARCHIVE_REPOSITORIES = """
SELECT 'https://github.com/c' || CAST(c_custkey AS STRING) || '/r' AS normalized_url, 'c' || CAST(c_custkey AS STRING) || '/R' AS full_name, CAST(c_custkey AS BIGINT) AS stars FROM {customer} WHERE c_custkey % 4 <> 0
"""


@query("""
WITH papers AS (SELECT * FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 6 <> 0),
joined AS (SELECT p.o_orderkey, b.o_orderkey IS NOT NULL AS known, b.o_orderkey AS bk, c_custkey FROM papers p
  LEFT JOIN orders b ON b.o_orderkey = p.o_orderkey AND b.o_orderkey % 5 <> 0 LEFT JOIN customer c ON c.c_custkey = p.o_custkey AND c.c_custkey % 4 <> 0)
SELECT o_orderkey, sha256('papers_with_code' || chr(31) || 'https://papers.example.org/paper/p' || o_orderkey) AS record_id, CASE WHEN NOT known THEN 'metadata_missing' WHEN c_custkey IS NULL THEN 'repository_unverified' END AS reject_reason,
  CASE WHEN known THEN 'Title ' || bk ELSE 'Paper ' || o_orderkey END AS title, c_custkey AS stars,
  CASE WHEN NOT known THEN 'content.published_date:missing' ELSE '' END AS problems FROM joined""")
def paper_records(spark: SparkSession, folder: str) -> DataFrame:
    """Archive rows joined to their bibliography and repositories, with the reason of each rejection."""
    pages = derive(spark, folder, ARCHIVE_PAGES).select("o_orderkey", "body")
    candidates = _with_raw(
        archive.archive_candidates(archive.archive_rows(pages, "body")), "papers_with_code", F.col("canonical_url")
    ).withColumns(
        {"published_at": F.lit(None).cast("timestamp"), "authors": F.array().cast("array<string>"), "abstract": F.lit(None).cast("string")}
    )
    bibliography = derive(spark, folder, ARCHIVE_BIBLIOGRAPHY).withColumns(
        {"published_at": F.col("published_at").cast("timestamp"), "authors": F.array(F.lit("A. Author"))}
    )
    made = ingest.paper_records(candidates, bibliography, derive(spark, folder, ARCHIVE_REPOSITORIES), "o_orderkey")
    return made.select(
        "o_orderkey",
        "record_id",
        "reject_reason",
        F.get_json_object("payload", "$.content.title").alias("title"),
        F.get_json_object("payload", "$.content.github_stars").cast("bigint").alias("stars"),
        F.array_join("problems", ",").alias("problems"),
    )


@query("""
WITH papers AS (SELECT * FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 6 <> 0),
joined AS (SELECT p.o_orderkey, b.o_orderkey IS NOT NULL AS known, c_custkey, 'arxiv:' || (2401 + p.o_orderkey // 90000) || '.' || (10000 + p.o_orderkey % 90000) AS arxiv,
    sha256('papers_with_code' || chr(31) || sha256('https://papers.example.org/paper/p' || p.o_orderkey)) AS own FROM papers p
  LEFT JOIN orders b ON b.o_orderkey = p.o_orderkey AND b.o_orderkey % 5 <> 0 LEFT JOIN customer c ON c.c_custkey = p.o_custkey AND c.c_custkey % 4 <> 0)
SELECT o_orderkey, CASE WHEN NOT known THEN 'metadata_missing' WHEN c_custkey IS NULL THEN 'repository_unverified' WHEN o_orderkey % 13 = 0 THEN 'raw_document_missing' END AS reject_reason,
  '["' || own || '"' || CASE WHEN known THEN ',"' || arxiv || '"' ELSE '' END || CASE WHEN c_custkey IS NOT NULL THEN ',"github:c' || c_custkey || '"' ELSE '' END || ']' AS raw_document_ids,
  CASE WHEN known THEN arxiv END AS bibliographic_id, CASE WHEN known THEN 'arxiv_atom_v1' END AS bibliographic_parser, CASE WHEN c_custkey IS NOT NULL THEN 'github:c' || c_custkey END AS repository_id FROM joined""")
def paper_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Raw documents behind each paper record, all of which must be stored; some bibliographic ones are not."""
    pages = derive(spark, folder, ARCHIVE_PAGES).select("o_orderkey", "body")
    candidates = _with_raw(
        archive.archive_candidates(archive.archive_rows(pages, "body")), "papers_with_code", F.col("canonical_url")
    ).withColumns(
        {"published_at": F.lit(None).cast("timestamp"), "authors": F.array().cast("array<string>"), "abstract": F.lit(None).cast("string")}
    )
    # The run and the list of its stored documents read the same candidates; they are parsed once.
    candidates = materialize(candidates, "archive-candidates")
    bibliography = derive(spark, folder, ARCHIVE_BIBLIOGRAPHY).withColumns(
        {
            "published_at": F.col("published_at").cast("timestamp"),
            "authors": F.array(F.lit("A. Author")),
            "raw_document_id": F.concat(F.lit("arxiv:"), "arxiv_id"),
            "original_url": F.col("paper_url"),
        }
    )
    repositories = derive(spark, folder, ARCHIVE_REPOSITORIES).withColumn(
        "raw_document_id", F.concat(F.lit("github:c"), F.col("stars").cast("string"))
    )
    number = F.regexp_extract("title", r"([0-9]+)$", 1).cast("long")
    stored = (
        candidates.select("raw_document_id")
        .unionByName(bibliography.filter(number % 13 != 0).select("raw_document_id"))
        .unionByName(repositories.select("raw_document_id"))
    )
    made = ingest.paper_records(candidates, bibliography, repositories, "o_orderkey", raw_documents=stored)
    field = lambda name: F.get_json_object("payload", f"$.provenance.extractionMetadata.{name}")
    return made.select(
        "o_orderkey",
        "reject_reason",
        field("raw_document_ids").alias("raw_document_ids"),
        field("bibliographic_raw_document_id").alias("bibliographic_id"),
        field("bibliographic_parser").alias("bibliographic_parser"),
        field("github_api_raw_document_id").alias("repository_id"),
    )


def _supplier_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, SEEDS).select("entity_id", "canonical_name", F.array("alias").alias("aliases"))


@query("""
SELECT s_suppkey, sha256('ycombinator' || chr(31) || 'https://s.example.org/c/' || s_suppkey) AS record_id, CASE WHEN s_suppkey % 4 = 0 THEN 'Again' ELSE s_name END AS entity_name,
  CASE WHEN s_suppkey % 4 <> 0 THEN 'supplier:' || s_suppkey END AS entity_id, 'Y Combinator' AS source_name,
  '' AS problems
FROM supplier""")
def startup_records(spark: SparkSession, folder: str) -> DataFrame:
    found = directories.organization_candidates(derive(spark, folder, ORGANIZATION_PAGES), "html", "s_suppkey")
    candidates = _with_raw(found, "ycombinator", F.col("canonical_url"))
    made = ingest.startup_records(candidates, "s_suppkey", seeds=_supplier_seeds(spark, folder))
    field = lambda path: F.get_json_object("payload", path)
    return made.select(
        "s_suppkey",
        "record_id",
        field("$.content.entityName").alias("entity_name"),
        field("$.content.data.canonicalEntityId").alias("entity_id"),
        field("$.source.name").alias("source_name"),
        F.array_join("problems", ",").alias("problems"),
    )


@query("""
SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'Again' ELSE s_name END AS raw_name, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS canonical_name, 'ycombinator' AS source,
  CASE WHEN s_suppkey % 4 = 0 THEN 'unresolved' ELSE 'exact' END AS method, CASE WHEN s_suppkey % 4 = 0 THEN 2.0::DOUBLE / 22 ELSE 1.0::DOUBLE END AS confidence,
  CASE WHEN s_suppkey % 4 = 0 THEN 'UNRESOLVED' ELSE 'AUTO_MATCH' END AS status, sha256('ycombinator' || chr(31) || 'https://s.example.org/c/' || s_suppkey) AS record_id
FROM supplier""")
def startup_mapping_log(spark: SparkSession, folder: str) -> DataFrame:
    """How a run mapped the names of the startups it stored, with the names as they were found."""
    found = directories.organization_candidates(derive(spark, folder, ORGANIZATION_PAGES), "html", "s_suppkey")
    candidates = _with_raw(found, "ycombinator", F.col("canonical_url"))
    log = ingest.startup_mappings(candidates, "s_suppkey", _supplier_seeds(spark, folder))
    return log.select(
        F.col("rawName").alias("raw_name"), F.col("canonicalName").alias("canonical_name"), "source", "method", "confidence", "status",
        F.col("recordId").alias("record_id"),
    )


@query("""
WITH priced AS (SELECT *, CASE p_partkey % 9 WHEN 0 THEN 'FREEMIUM' WHEN 1 THEN 'FREE' WHEN 2 THEN 'FREE' WHEN 3 THEN 'FREE' WHEN 4 THEN 'PAID' WHEN 5 THEN 'ENTERPRISE' WHEN 6 THEN 'FREEMIUM' END AS pricing FROM part)
SELECT p_partkey, sha256('product_hunt' || chr(31) || 'https://p.example.org/i/' || p_partkey) AS record_id, CASE WHEN p_partkey % 11 = 0 THEN 'PAID' ELSE pricing END AS pricing_model,
  CASE WHEN p_partkey % 11 = 0 THEN 'llm_augmented' ELSE 'deterministic' END AS method, '' AS problems
FROM priced WHERE pricing IS NOT NULL AND p_partkey % 5 <> 2""")
def product_records(spark: SparkSession, folder: str) -> DataFrame:
    """Product records; every eleventh product has landed model facts."""
    found = directories.product_candidates(derive(spark, folder, PRODUCT_PAGES), "html", "p_partkey")
    facts = derive(
        spark, folder,
        "SELECT 'https://p.example.org/i/' || CAST(p_partkey AS STRING) AS canonical_url, p_name AS startup_name, 'PAID' AS pricing_model FROM {part} WHERE p_partkey % 11 = 0",
    )
    made = ingest.product_records(_with_raw(found, "product_hunt", F.col("canonical_url")), "p_partkey", extracted=facts)
    return made.select(
        "p_partkey",
        "record_id",
        F.get_json_object("payload", "$.content.pricingModel").alias("pricing_model"),
        F.get_json_object("payload", "$.provenance.extractionMethod").alias("method"),
        F.array_join("problems", ",").alias("problems"),
    )


@query(f"""
WITH found AS (SELECT *, p_partkey % 3 = 0 AS known FROM part WHERE p_partkey % 5 <> 2),
made AS (SELECT *, p_partkey % 9 IN (0, 1, 2, 3, 4, 5, 6) AS valid FROM found),
counted AS (SELECT (SELECT count(*) FROM part) AS discovered, count(*) FILTER (valid) AS parsed, count(*) FILTER (valid AND NOT known) AS inserted,
  count(*) FILTER (valid AND known) AS duplicates, 0::BIGINT AS rejected FROM made)
SELECT s AS source_id, counted.* FROM counted, (VALUES ('product_hunt'), (NULL)) AS sources(s)""")
def product_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The counters of a product run into a table that holds every third product."""
    pages = derive(spark, folder, PRODUCT_PAGES)
    found = directories.product_candidates(pages, "html", "p_partkey")
    made = ingest.product_records(_with_raw(found, "product_hunt", F.col("canonical_url")), "p_partkey")
    address = F.concat(F.lit("https://p.example.org/i/"), F.col("p_partkey").cast("string"))
    stored = table(spark, folder, "part").filter("p_partkey % 3 = 0").select(identity.record_id(F.lit("product_hunt"), address).alias("record_id"))
    documents = pages.select(F.lit("product_hunt").alias("source_id"))
    return ingest.record_summary(made, documents, stored, "p_partkey")


@query("""
SELECT 'Products' AS tab, sha256('product_hunt' || chr(31) || 'https://p.example.org/i/' || p_partkey) AS record_id, NULL AS raw_name, NULL AS status
FROM part WHERE p_partkey % 9 IN (0, 1, 2, 3, 4, 5, 6) AND p_partkey % 5 <> 2
UNION ALL
SELECT 'Entity Mapping Log', sha256('ycombinator' || chr(31) || 'https://s.example.org/c/' || s_suppkey), CASE WHEN s_suppkey % 4 = 0 THEN 'Again' ELSE s_name END,
  CASE WHEN s_suppkey % 4 = 0 THEN 'UNRESOLVED' ELSE 'AUTO_MATCH' END FROM supplier""")
def stored_export(spark: SparkSession, folder: str) -> DataFrame:
    """Products and a mapping log are stored, each batch twice, and exported from their tables."""
    root = scratch_path(spark, "tables")
    found = directories.product_candidates(derive(spark, folder, PRODUCT_PAGES), "html", "p_partkey")
    made = ingest.product_records(_with_raw(found, "product_hunt", F.col("canonical_url")), "p_partkey")
    valid = made.filter(F.size("problems") == 0).select("p_partkey", "record_id", "payload")
    found = directories.organization_candidates(derive(spark, folder, ORGANIZATION_PAGES), "html", "s_suppkey")
    log = ingest.startup_mappings(_with_raw(found, "ycombinator", F.col("canonical_url")), "s_suppkey", _supplier_seeds(spark, folder))
    # Each write reads its rows twice; they are parsed and built once.
    valid, log = materialize(valid, "products"), materialize(log, "mappings")
    for _ in range(2):
        write_batch(valid, f"{root}/products", 1, "record_id", "p_partkey")
        write_batch(log, f"{root}/entity_mapping_log", 1, "recordId", "mappingId")
    paths = write_csv(read_tabs(spark, root), scratch_path(spark, "export"))
    read = lambda tab: spark.read.option("header", True).option("escape", '"').csv(paths[tab]).withColumn("tab", F.lit(tab))
    none = F.lit(None).cast("string")
    products = read("Products").select("tab", F.col("recordId").alias("record_id"), none.alias("raw_name"), none.alias("status"))
    return products.unionByName(read("Entity Mapping Log").select("tab", F.col("recordId").alias("record_id"), F.col("rawName").alias("raw_name"), "status"))
