"""Lookups, record rules, insert-only storage and export over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.functions.cells import tabularize
from lodegate.functions.dates import utc_text
from lodegate.operators import enrichment, export, storage
from lodegate.operators.records import violations
from lodegate.plans.documents import _BARE, _squeezed
from lodegate.plans.registry import derive, plain, query, table
from lodegate.session import scratch_path
from lodegate.scale import parallel
from lodegate.sources.pagination import offset_pages, path_pages, query_pages, start_pages

PAPERS = """
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'none' ELSE 'id' || CAST(o_custkey AS STRING) END AS arxiv_id, 'https://arxiv.org/abs/' || CAST(o_custkey AS STRING) AS paper_url,
  'Order ' || CAST(o_orderkey AS STRING) AS title, CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS published_at,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'https://www.github.com/C/' || CAST(o_custkey AS STRING) || '.git' WHEN 2 THEN 'https://github.com/c' ELSE 'HTTP://github.com/c/' || CAST(o_custkey AS STRING) || '/' END AS github_url
FROM {orders}
"""
BIBLIOGRAPHY = """
SELECT 'id' || CAST(c_custkey AS STRING) AS arxiv_id, 'https://arxiv.org/abs/' || CAST(CASE WHEN c_custkey % 6 = 0 THEN 0 ELSE c_custkey END AS STRING) AS paper_url, c_name AS title,
  CAST('2024-01-01 00:00:00' AS TIMESTAMP) + c_nationkey * INTERVAL '1' DAY AS published_at, c_mktsegment AS abstract FROM {customer} WHERE c_custkey % 5 <> 0
UNION ALL SELECT 'id' || CAST(c_custkey AS STRING), 'https://arxiv.org/abs/' || CAST(c_custkey AS STRING), c_name, CAST('2024-01-01 00:00:00' AS TIMESTAMP), c_mktsegment FROM {customer} WHERE c_custkey % 8 = 0
"""
REPOSITORIES = """
SELECT 'https://github.com/c/' || CAST(c_custkey AS STRING) AS normalized_url, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'c/' || CAST(c_custkey AS STRING) END AS full_name, CAST(round(c_acctbal) AS BIGINT) AS stars
FROM {customer} WHERE c_custkey % 3 <> 0
"""


def _papers(spark: SparkSession, folder: str) -> DataFrame:
    papers = derive(spark, folder, PAPERS).withColumn("published_at", F.col("published_at").cast("timestamp"))
    return papers.withColumns({"authors": F.array().cast("array<string>"), "abstract": F.lit(None).cast("string")})


@query(f"""
WITH papers AS ({plain(PAPERS)}), bib AS ({plain(BIBLIOGRAPHY)}),
single AS (SELECT arxiv_id, count(*) AS n, any_value(paper_url) AS url, any_value(title) AS title, any_value(published_at) AS at, any_value(abstract) AS abstract FROM bib GROUP BY arxiv_id),
joined AS (SELECT p.*, n, url, single.title AS t, single.at AS told_at, abstract, CASE WHEN published_at IS NULL THEN CASE WHEN p.arxiv_id = '' THEN 'missing_arxiv_id' WHEN n IS NULL THEN 'metadata_missing'
   WHEN n <> 1 THEN 'metadata_ambiguous' WHEN url <> paper_url THEN 'metadata_mismatch' END END AS reject_reason FROM papers p LEFT JOIN single ON p.arxiv_id = single.arxiv_id)
SELECT o_orderkey, CASE WHEN published_at IS NULL AND reject_reason IS NULL THEN t ELSE title END AS title,
  strftime(CASE WHEN published_at IS NULL AND reject_reason IS NULL THEN told_at ELSE published_at END, '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at,
  CASE WHEN published_at IS NULL AND reject_reason IS NULL THEN abstract END AS abstract, reject_reason FROM joined""")
def bibliography_join(spark: SparkSession, folder: str) -> DataFrame:
    bibliography = derive(spark, folder, BIBLIOGRAPHY).withColumns(
        {"published_at": F.col("published_at").cast("timestamp"), "authors": F.array(F.lit("A. Author"))}
    )
    hydrated = enrichment.hydrate(_papers(spark, folder), bibliography, "o_orderkey")
    return hydrated.select("o_orderkey", "title", utc_text(F.col("published_at")).alias("published_at"), "abstract", "reject_reason")


@query(f"""
WITH papers AS ({plain(PAPERS)}), repos AS ({plain(REPOSITORIES)}),
keyed AS (SELECT *, CASE o_orderkey % 4 WHEN 1 THEN 'https://github.com/c/' || split_part(split_part(github_url, '/C/', 2), '.git', 1) WHEN 3 THEN 'https://github.com/c/' || split_part(github_url, '/', 5) END AS url FROM papers),
joined AS (SELECT k.*, r.full_name, r.stars FROM keyed k LEFT JOIN repos r ON k.url = r.normalized_url AND r.stars >= 0 AND r.full_name <> '')
SELECT o_orderkey, coalesce(url, github_url) AS github_url, full_name, stars, CASE WHEN github_url IS NULL THEN NULL WHEN url IS NULL THEN 'not_a_repository' WHEN stars IS NULL THEN 'repository_unverified' END AS reject_reason
FROM joined""")
def repository_stars(spark: SparkSession, folder: str) -> DataFrame:
    starred = enrichment.add_repository(_papers(spark, folder), derive(spark, folder, REPOSITORIES), "o_orderkey")
    return starred.select("o_orderkey", "github_url", "full_name", "stars", "reject_reason")


@query(f"""WITH papers AS ({plain(PAPERS)})
SELECT DISTINCT CASE o_orderkey % 4 WHEN 1 THEN 'https://github.com/c/' || split_part(split_part(github_url, '/C/', 2), '.git', 1) ELSE 'https://github.com/c/' || split_part(github_url, '/', 5) END AS normalized_url
FROM papers WHERE o_orderkey % 4 IN (1, 3)""")
def repository_lookups(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.needed_lookups(_papers(spark, folder))


ARTICLE_NEWS = """
SELECT page_id, url AS original_url, CASE WHEN page_id % 2 = 0 THEN 'Feed title' END AS title, CASE WHEN page_id % 3 = 0 THEN repeat('long text ', 5000) ELSE 'short' END AS body,
  CASE WHEN page_id % 4 = 0 THEN 'Reporter' END AS author, CAST('2024-01-20 00:00:00' AS TIMESTAMP) AS published_at, 'rss' AS date_source, CAST(0.85 AS DOUBLE) AS date_confidence
FROM {pages}
"""
_SHOWN = f"""
cut AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS article,
  regexp_replace(regexp_replace(regexp_extract(html, '(?s)</head>(.*)$', 1), '(?s)<nav>.*?</nav>', '', 'g'), '(?s)<footer>.*?</footer>', '', 'g') AS page FROM pages),
read AS (SELECT page_id, {_squeezed('title')} AS title, {_squeezed(_BARE.format('article'))} AS article,
  {_squeezed(_BARE.format("regexp_replace(page, '(?s)<!--.*?-->', '', 'g')"))} AS page FROM cut),
shown AS (SELECT page_id, title, CASE WHEN length(article) >= 150 THEN article ELSE page END AS body FROM read)
"""


@query(f"""WITH {_SHOWN}, news AS ({plain(ARTICLE_NEWS)})
SELECT n.page_id, CASE WHEN n.page_id % 5 <> 0 AND s.title <> '' THEN s.title ELSE n.title END AS title,
  sha256(CASE WHEN n.page_id % 5 <> 0 AND length(CASE WHEN length(s.body) < 50 THEN n.body ELSE s.body END) >= length(n.body) THEN CASE WHEN length(s.body) < 50 THEN n.body ELSE s.body END ELSE n.body END) AS body_hash,
  n.author, n.date_source, n.date_confidence FROM news n JOIN shown s ON n.page_id = s.page_id""")
def article_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    """News completed from landed articles; every fifth article is not landed."""
    now = F.lit("2024-01-30 12:00:00+00:00").cast("timestamp")
    pages = table(spark, folder, "pages").filter("page_id % 5 <> 0").select(F.col("url").alias("original_url"), "html")
    news = derive(spark, folder, ARTICLE_NEWS).withColumn("published_at", F.col("published_at").cast("timestamp"))
    enriched = enrichment.enrich_news(news, pages, "page_id", now)
    return enriched.select("page_id", "title", F.sha2("body", 256).alias("body_hash"), "author", "date_source", "date_confidence")


ORDER_BATCH = """
SELECT o_orderkey, 'rec' || CAST(o_custkey % 500 AS STRING) || CASE WHEN o_orderkey % 3 = 0 THEN 'a' ELSE 'b' END AS record_id FROM {orders}
"""
STORED = "SELECT 'rec' || CAST(c_custkey AS STRING) || 'a' AS record_id FROM {customer} WHERE c_custkey % 2 = 0"


@query(f"""WITH batch AS ({plain(ORDER_BATCH)}), stored AS ({plain(STORED)})
SELECT o_orderkey, record_id, record_id NOT IN (SELECT record_id FROM stored) AND row_number() OVER (PARTITION BY record_id ORDER BY o_orderkey) = 1 AS inserted FROM batch""")
def insert_flags(spark: SparkSession, folder: str) -> DataFrame:
    return storage.inserted_flags(derive(spark, folder, ORDER_BATCH), derive(spark, folder, STORED), "record_id", "o_orderkey")


@query(f"""WITH batch AS ({plain(ORDER_BATCH)}), stored AS ({plain(STORED)}),
flags AS (SELECT o.o_orderstatus, o.o_orderkey % 11 = 0 AS rejected, record_id NOT IN (SELECT record_id FROM stored) AND row_number() OVER (PARTITION BY record_id ORDER BY b.o_orderkey) = 1 AS inserted
  FROM batch b JOIN orders o ON b.o_orderkey = o.o_orderkey)
SELECT o_orderstatus, count(*) AS parsed, count(*) FILTER (NOT rejected AND inserted) AS inserted, count(*) FILTER (NOT rejected AND NOT inserted) AS duplicates, count(*) FILTER (rejected) AS rejected
FROM flags GROUP BY ROLLUP (o_orderstatus)""")
def ingest_totals(spark: SparkSession, folder: str) -> DataFrame:
    status = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 11 == 0, "bad").alias("reject_reason")
    )
    return storage.insert_counts(insert_flags(spark, folder).join(status, "o_orderkey"), "o_orderstatus")


@query("SELECT o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def latest_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return storage.latest_per_key(orders, "o_custkey", "o_orderkey").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def missing_raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    documents = table(spark, folder, "orders").filter("o_orderstatus <> 'P'")
    spread = F.col("l_linenumber")
    return storage.missing_references(lines, "l_orderkey", documents, "o_orderkey", spread)


# Product records as JSON with one deviation each.
PRODUCT_RECORDS = """
SELECT p_partkey, '{{"recordId":"' || CASE WHEN p_partkey % 14 = 1 THEN '' ELSE 'r' END || '","schemaVersion":"1.0","' || CASE WHEN p_partkey % 14 = 2 THEN 'record_type' ELSE 'recordType' END || '":"' || CASE WHEN p_partkey % 14 = 3 THEN 'NEWS' ELSE 'PRODUCT' END
  || '","source":{{"name":"s","url":"' || CASE WHEN p_partkey % 14 = 4 THEN 'mailto:x' ELSE 'http://a.b/' END || '","canonicalUrl":"https://a.b/"}},"collectedAt":"2024-01-01T00:00:00' || CASE WHEN p_partkey % 14 = 5 THEN '' ELSE 'Z' END
  || '","provenance":{{"retrievedAt":"2024-01-01T00:00:00+02:00","contentHash":"' || repeat(CASE WHEN p_partkey % 14 = 6 THEN 'G' ELSE 'a' END, 64) || '","rawDocumentId":"d","extractionMethod":"deterministic","extractionMetadata":{{"any":[1]}},"validationStatus":"VALID"'
  || CASE WHEN p_partkey % 14 = 7 THEN ',"extra":1' ELSE '' END || '}},"content":{{"productName":"' || p_name || '","startupName":' || CASE WHEN p_partkey % 14 = 8 THEN 'null' ELSE '"' || p_brand || '"' END || ',"pricingModel":"' || CASE WHEN p_partkey % 14 = 9 THEN 'CHEAP' ELSE 'FREE' END
  || '","resolutionConfidence":' || CASE WHEN p_partkey % 14 = 10 THEN '1.5' WHEN p_partkey % 14 = 11 THEN '"x"' ELSE '0.5' END || CASE WHEN p_partkey % 14 = 12 THEN ',"canonicalEntityId":""' ELSE '' END || '}}}}' || CASE WHEN p_partkey % 14 = 13 THEN ']' ELSE '' END AS payload
FROM {part}
"""


@query("""
SELECT p_partkey, CASE p_partkey % 14 WHEN 1 THEN 'recordId:invalid' WHEN 3 THEN 'recordType:invalid' WHEN 4 THEN 'source.url:invalid' WHEN 5 THEN 'collectedAt:invalid' WHEN 6 THEN 'provenance.contentHash:invalid' WHEN 7 THEN 'provenance.extra:unknown'
  WHEN 8 THEN 'content.startupName:missing' WHEN 9 THEN 'content.pricingModel:invalid' WHEN 10 THEN 'content.resolutionConfidence:invalid' WHEN 11 THEN 'content.resolutionConfidence:invalid' WHEN 12 THEN 'content.canonicalEntityId:invalid'
  WHEN 13 THEN 'record:invalid' ELSE '' END AS problems FROM part""")
def record_problems(spark: SparkSession, folder: str) -> DataFrame:
    records = parallel(derive(spark, folder, PRODUCT_RECORDS))
    return records.select("p_partkey", F.array_join(violations(F.col("payload"), "PRODUCT"), ",").alias("problems"))


@query("""
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_custkey % 2 = 0 THEN 'True' ELSE 'False' END AS even,
  '{"a": ' || o_custkey || ', "b": ["' || o_orderpriority || '", null]}' AS nested FROM orders""")
def export_cells(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_custkey") % 2 == 0).alias("even"),
        F.struct(F.array("o_orderpriority", F.lit(None).cast("string")).alias("b"), F.col("o_custkey").alias("a")).alias("nested"),
    )
    return tabularize(orders)


@query("""
SELECT 'Startups' AS tab, count(*) AS records FROM supplier UNION ALL SELECT 'Products', count(*) FROM part UNION ALL SELECT 'Research Papers', count(*) FROM orders
UNION ALL SELECT 'Jobs', count(*) FROM lineitem UNION ALL SELECT 'News', count(*) FROM documents UNION ALL SELECT 'Entity Mapping Log', count(*) FROM customer""")
def tab_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = ("supplier", "part", "orders", "lineitem", "documents", "customer")
    return export.tab_counts(dict(zip(export.REQUIRED_TABS, (table(spark, folder, name) for name in names))))


@query("""
SELECT 'Startups' AS tab, s_suppkey::VARCHAR AS key, s_name AS name, '' AS size FROM supplier UNION ALL SELECT 'Products', p_partkey::VARCHAR, p_name, p_size::VARCHAR FROM part""")
def tab_union(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_size").alias("size")
    )
    return export.union_tabs({"Startups": suppliers, "Products": parts})


PAYLOADS = """
SELECT event_id, '{{"recordId":"e' || CAST(event_id AS STRING) || '",' || CASE WHEN event_id % 4 = 1 THEN '"' || event_type || '":true,' ELSE '' END || '"content":{{"z":' || CAST(user_id AS STRING) || ',"a":[null,"é"]}},"user":' || CAST(user_id AS STRING) || ',"gone":null}}' AS payload
FROM {events}
"""


@query("""
SELECT event_id, 'e' || event_id AS record_id, '{"a": [null, "\\u00e9"], "z": ' || user_id || '}' AS content, user_id::VARCHAR AS user_cell, '' AS gone, CASE WHEN event_id % 4 = 1 AND event_type = 'view' THEN 'True' ELSE '' END AS view_cell FROM events""")
def payload_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of JSON records along a fixed list of headers."""
    rows = export.payload_cells(derive(spark, folder, PAYLOADS), "payload")
    headers = ["recordId", "content", "user", "gone", "view"]
    names = ["record_id", "content", "user_cell", "gone", "view_cell"]
    values = export.matrix(rows, "cells", "event_id", headers)
    return values.select("event_id", *[F.col("values")[i].alias(name) for i, name in enumerate(names)])


_HEADERS_SQL = """WITH keys AS (SELECT event_id, unnest(CASE WHEN event_id % 4 = 1 THEN ['recordId', event_type, 'content', 'user', 'gone'] ELSE ['recordId', 'content', 'user', 'gone'] END) AS header,
  unnest(CASE WHEN event_id % 4 = 1 THEN [0, 1, 2, 3, 4] ELSE [0, 1, 2, 3] END) AS at_key FROM events),
firsts AS (SELECT header, min(event_id * 10 + at_key) AS f FROM keys GROUP BY header)
"""


@query(_HEADERS_SQL + """SELECT header, row_number() OVER (ORDER BY f) - 1 AS position FROM firsts""")
def header_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = export.payload_cells(derive(spark, folder, PAYLOADS), "payload")
    return export.header_union(rows, "cells", "event_id")


@query(_HEADERS_SQL + r"""
SELECT 'News' AS tab, (SELECT string_agg(header, ',' ORDER BY f) FROM firsts) AS headers, 'e' || event_id AS record_id, '{"a": [null, "\u00e9"], "z": ' || user_id || '}' AS content FROM events
UNION ALL SELECT unnest(['Startups', 'Products', 'Research Papers', 'Jobs', 'Entity Mapping Log']), 'record', NULL, NULL""")
def exported_tabs(spark: SparkSession, folder: str) -> DataFrame:
    """The six CSV tabs, written and read back: payload fields of News, a bare header for the others."""
    paths = export.write_csv({"News": derive(spark, folder, PAYLOADS)}, scratch_path(spark, "export"))
    shown = None
    for tab, path in paths.items():
        read = spark.read.option("header", True).option("escape", '"').csv(path)
        headers = F.lit(",".join(read.columns)).alias("headers")
        if tab == "News":
            rows = read.select(F.lit(tab).alias("tab"), headers, F.col("recordId").alias("record_id"), "content")
        else:
            none = F.lit(None).cast("string")
            rows = read.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit(tab).alias("tab"), headers, none.alias("record_id"), none.alias("content"))
        shown = rows if shown is None else shown.unionByName(rows)
    return shown


LISTINGS = """
SELECT s_suppkey, 'https://l.example.org/' || CAST(s_suppkey AS STRING) || CASE WHEN s_suppkey % 2 = 0 THEN '/?q=a+b&page=9&q=c' ELSE '/' END AS listing_url,
  'https://l.example.org/rows?offset={{offset}}&length={{length}}' AS offset_template, CASE WHEN s_suppkey % 3 = 0 THEN 'https://l.example.org/feed' ELSE 'https://l.example.org/q?start={{start}}&max_results={{max_results}}' END AS start_template,
  CAST(10 + s_suppkey % 7 AS BIGINT) AS page_size, CAST(1 + floor(s_acctbal) % 100 + 100 AS BIGINT) AS max_records
FROM {supplier}
"""


@query(f"""WITH raw AS ({plain(LISTINGS)}), pages AS (SELECT *, unnest(range(0, max_records, page_size)) AS o FROM raw)
SELECT s_suppkey, 'https://l.example.org/rows?offset=' || o || '&length=' || least(page_size, max_records - o) AS url FROM pages""")
def offset_pagination(spark: SparkSession, folder: str) -> DataFrame:
    return offset_pages(derive(spark, folder, LISTINGS), "offset_template", "page_size", "max_records").select("s_suppkey", "url")


@query(f"""WITH raw AS ({plain(LISTINGS)}), pages AS (SELECT *, unnest(range(0, CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE max_records END, page_size)) AS o FROM raw)
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN start_template ELSE 'https://l.example.org/q?start=' || o || '&max_results=' || page_size END AS url FROM pages""")
def start_pagination(spark: SparkSession, folder: str) -> DataFrame:
    return start_pages(derive(spark, folder, LISTINGS), "start_template", "page_size", "max_records").select("s_suppkey", "url")


@query(f"""WITH raw AS ({plain(LISTINGS)}), pages AS (SELECT *, unnest(range(1, ceil(max_records / page_size)::BIGINT + 1)) AS p FROM raw)
SELECT s_suppkey, 'https://l.example.org/' || s_suppkey || '/?' || CASE WHEN s_suppkey % 2 = 0 THEN 'q=c&' ELSE '' END || 'page=' || p AS by_query,
  CASE WHEN s_suppkey % 2 = 0 THEN 'https://l.example.org/' || s_suppkey || '/?q=a+b&page=9&q=c' ELSE 'https://l.example.org/' || s_suppkey END || CASE WHEN p > 1 THEN '/page/' || p || '/' ELSE '' END AS by_path FROM pages""")
def page_pagination(spark: SparkSession, folder: str) -> DataFrame:
    listings = derive(spark, folder, LISTINGS)
    by_query = query_pages(listings, "listing_url", "page_size", "max_records").select("s_suppkey", "page", F.col("url").alias("by_query"))
    by_path = path_pages(listings, "listing_url", "page_size", "max_records").select("s_suppkey", "page", F.col("url").alias("by_path"))
    return by_query.join(by_path, ["s_suppkey", "page"]).select("s_suppkey", "by_query", "by_path")
