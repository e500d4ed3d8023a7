"""Markup, feeds, archives and directories over pages, parts, suppliers and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.functions.binding import stage
from lodegate.functions.dates import date_evidence, utc_text
from lodegate.functions.directory import card_pricing
from lodegate.functions.markup import evidence_pieces, is_thin_page
from lodegate.functions.text import casefold, is_remote, role_family
from lodegate.operators.enrichment import read_articles
from lodegate.plans.registry import derive, plain, query, table
from lodegate.scale import parallel
from lodegate.sources import archive, directories, feeds

def _now():
    return F.lit("2024-01-30 12:00:00+00:00").cast("timestamp")


# Entities that occur in the given pages, for the reference SQL.
UNESCAPE = "replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"


def _squeezed(sql: str) -> str:
    return f"trim(regexp_replace({UNESCAPE.format(sql)}, '[\\s\\p{{Z}}]+', ' ', 'g'))"


_BARE = "regexp_replace(regexp_replace({0}, '>\\s+<', '><', 'g'), '<[^>]*>', '', 'g')"


@query(f"""
WITH cut AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS article,
  regexp_replace(regexp_replace(regexp_extract(html, '(?s)</head>(.*)$', 1), '(?s)<nav>.*?</nav>', '', 'g'), '(?s)<footer>.*?</footer>', '', 'g') AS page FROM pages),
shown AS (SELECT page_id, {_squeezed('title')} AS title, {_squeezed(_BARE.format('article'))} AS article,
  {_squeezed(_BARE.format("regexp_replace(page, '(?s)<!--.*?-->', '', 'g')"))} AS page FROM cut)
SELECT page_id, nullif(title, '') AS title, CASE WHEN length(article) >= 150 THEN article ELSE page END AS body,
  CAST(NULL AS VARCHAR) AS author, CAST(NULL AS VARCHAR) AS date_source FROM shown""")
def page_article(spark: SparkSession, folder: str) -> DataFrame:
    read = read_articles(table(spark, folder, "pages").select("page_id", "html"), "html", F.lit(""), _now())
    return read.select(
        "page_id",
        F.col("article_title").alias("title"),
        F.col("article_body").alias("body"),
        F.col("article_author").alias("author"),
        F.col("article_date.source").alias("date_source"),
    )


# Pages with date markup of each kind put in front of the given markup.
DATED_PAGES = """
SELECT page_id, CASE page_id % 6
  WHEN 0 THEN '<script type="application/ld+json">[{{"@type":"Article"}},{{"@graph":[{{"dateCreated":"soon","dateModified":"2024-01-' || right('0' || CAST(1 + page_id % 28 AS STRING), 2) || 'T10:00:00Z","author":{{"name":"Writer ' || CAST(page_id AS STRING) || '"}}}}]}}]</script>'
  WHEN 1 THEN '<meta name="Author" content=" Desk ' || CAST(page_id AS STRING) || ' "><meta property="og:published_time" content="2024-01-' || right('0' || CAST(1 + page_id % 28 AS STRING), 2) || '">'
  WHEN 2 THEN '<time datetime="bad"></time><time data-time="' || CAST(1 + page_id % 28 AS STRING) || ' Jan 2024"></time>'
  WHEN 3 THEN '<article>' || CASE WHEN page_id % 12 = 3 THEN repeat('At length. ', 200) ELSE '' END || 'Posted ' || CAST(page_id % 20 AS STRING) || ' hours ago. </article>'
  WHEN 4 THEN '<nav>3 days ago<br></nav>'
  ELSE '<script type="application/ld+json">{{"datePublished": broken}}</script><meta name="date" content="2024-01-05T05:00:00+02:00"/>' END || html AS html
FROM {pages}
"""


@query("""
WITH day AS (SELECT page_id, TIMESTAMP '2024-01-01' + to_days((page_id % 28)::INT) AS d FROM pages),
told AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN d + INTERVAL 10 HOUR WHEN 1 THEN d WHEN 2 THEN d
    WHEN 3 THEN TIMESTAMP '2024-01-30 12:00:00' - to_hours(page_id % 20) WHEN 5 THEN TIMESTAMP '2024-01-05 03:00:00' END AS told_at FROM day)
SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'json_ld' WHEN 1 THEN 'meta' WHEN 2 THEN 'time' WHEN 3 THEN 'relative' WHEN 5 THEN 'meta' END AS date_source,
  CAST(CASE page_id % 6 WHEN 0 THEN 0.95 WHEN 1 THEN 0.9 WHEN 2 THEN 0.85 WHEN 3 THEN 0.75 WHEN 5 THEN 0.9 ELSE 0 END AS DOUBLE) AS confidence,
  strftime(told_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at,
  CASE page_id % 6 WHEN 0 THEN 'Writer ' || page_id WHEN 1 THEN 'Desk ' || page_id END AS author,
  page_id % 6 = 4 AS hidden
FROM told""")
def page_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Dates and authors; an unclosed tag inside navigation hides the rest of its page."""
    read = read_articles(derive(spark, folder, DATED_PAGES), "html", F.lit(""), _now())
    return read.select(
        "page_id",
        F.col("article_date.source").alias("date_source"),
        F.col("article_date.confidence").alias("confidence"),
        utc_text(F.col("article_date.published_at")).alias("published_at"),
        F.col("article_author").alias("author"),
        (F.col("article_body") == "").alias("hidden"),
    )


@query("""
WITH day AS (SELECT page_id, TIMESTAMP '2024-01-01' + to_days((page_id % 28)::INT) AS d FROM pages),
told AS (SELECT page_id, CASE page_id % 6 WHEN 4 THEN TIMESTAMP '2024-01-27 12:00:00' WHEN 5 THEN TIMESTAMP '2024-01-05 03:00:00' END AS told_at FROM day)
SELECT page_id, CASE page_id % 6 WHEN 4 THEN 'relative' WHEN 5 THEN 'meta' END AS date_source, strftime(told_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at FROM told""")
def page_date_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Date evidence rules for any page; fewer notations of the same places count here."""
    read = derive(spark, folder, DATED_PAGES).withColumn("p", evidence_pieces(F.col("html")))
    chosen = date_evidence(_now(), **{k: F.col(f"p.{k}") for k in ("json_ld", "meta", "time", "visible", "relative")})
    return read.select("page_id", chosen.alias("e")).select(
        "page_id", F.col("e.source").alias("date_source"), utc_text(F.col("e.published_at")).alias("published_at")
    )


ANSWERED = """
SELECT page_id, CASE WHEN page_id % 10 = 7 THEN 503 WHEN page_id % 10 = 8 THEN 403 WHEN page_id % 10 = 9 THEN 404 ELSE 200 END AS status,
  CASE page_id % 10 WHEN 0 THEN substr(html, 1, 149) WHEN 1 THEN '<h1>JUST a Moment</h1>' || html WHEN 2 THEN replace(html, '<body>', '<body><i>DataDome</i>')
    WHEN 3 THEN html || repeat(' ', 5000) || 'datadome' ELSE html END AS body
FROM {pages}
"""


@query(f"""WITH raw AS ({plain(ANSWERED)})
SELECT page_id, status IN (403, 503) OR octet_length(encode(body)) < 150 OR regexp_matches(lower(body),
  'cf-browser-verification|challenge-platform|just a moment|checking your browser|ddos protection by|attention required|datadome') AS thin FROM raw""")
def thin_pages(spark: SparkSession, folder: str) -> DataFrame:
    answered = derive(spark, folder, ANSWERED)
    return answered.select("page_id", is_thin_page(F.col("status"), F.encode("body", "UTF-8")).alias("thin"))


# A feed of two items per order: one in RSS fields, one with fallbacks or gaps.
FEEDS = """
SELECT o_orderkey, '<?xml version="1.0" encoding="UTF-8"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:a="http://www.w3.org/2005/Atom"><channel><title>Orders</title><item><title> Order
  ' || CAST(o_orderkey AS STRING) || ' &amp; more</title><link>http://shop.example.org/o/' || CAST(o_orderkey AS STRING) || '?utm_source=rss</link><description><![CDATA[Remote <b>' || o_orderpriority
  || '</b> design]]></description><pubDate>Fri, 05 Jan 2024 10:' || right('0' || CAST(o_orderkey % 60 AS STRING), 2) || ':00 GMT</pubDate><author>Clerk ' || CAST(o_custkey AS STRING)
  || '</author></item><item><title>' || CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE 'Second' END || '</title><a:link href="' || CASE WHEN o_orderkey % 7 = 0 THEN 'mailto:x' ELSE 'https://shop.example.org/s/' END
  || CAST(o_orderkey AS STRING) || '"/><content:encoded>Product research</content:encoded><dc:date>2024-01-' || right('0' || CAST(1 + o_orderkey % 40 AS STRING), 2)
  || '</dc:date><dc:creator>' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END || '</dc:creator></item></channel></rss>' || CASE WHEN o_orderkey % 100 = 99 THEN '<' ELSE '' END AS xml
FROM {orders}
"""

_FEED_ITEMS_SQL = """
fed AS (SELECT * FROM orders WHERE o_orderkey % 100 <> 99),
items AS (
  SELECT o_orderkey, 0 AS item_position, 'https://shop.example.org/o/' || o_orderkey AS canonical_url, 'Order ' || o_orderkey || ' & more' AS title,
    'Remote <b>' || o_orderpriority || '</b> design' AS description, 'Clerk ' || o_custkey AS author,
    TIMESTAMP '2024-01-05 10:00:00' + to_minutes(o_orderkey % 60) AS published_at FROM fed
  UNION ALL
  SELECT o_orderkey, 1, 'https://shop.example.org/s/' || o_orderkey, 'Second', 'Product research', CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END,
    CASE WHEN o_orderkey % 40 < 31 THEN TIMESTAMP '2024-01-01' + to_days((o_orderkey % 40)::INT) END FROM fed WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0)
"""


def _feed_documents(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, FEEDS).select("o_orderkey", F.encode("xml", "UTF-8").alias("body"))


@query(f"""WITH {_FEED_ITEMS_SQL}
SELECT o_orderkey, item_position, canonical_url, title, description, author, strftime(published_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at,
  CASE WHEN published_at IS NOT NULL THEN 'rss' END AS date_source, CAST(CASE WHEN published_at IS NOT NULL THEN 0.85 ELSE 0 END AS DOUBLE) AS date_confidence FROM items""")
def feed_items(spark: SparkSession, folder: str) -> DataFrame:
    items = feeds.feed_items(_feed_documents(spark, folder), "body", _now())
    return items.withColumn("published_at", utc_text(F.col("published_at"))).drop("url")


@query(f"""WITH {_FEED_ITEMS_SQL}
SELECT o_orderkey, item_position, title, coalesce(author, 'Unknown company') AS company, item_position = 0 AS is_remote,
  CASE item_position WHEN 0 THEN 'Design' ELSE 'Research' END AS role_family FROM items""")
def job_postings(spark: SparkSession, folder: str) -> DataFrame:
    jobs = feeds.job_candidates(feeds.feed_items(_feed_documents(spark, folder), "body", _now()))
    return jobs.select("o_orderkey", "item_position", "title", "company", "is_remote", "role_family")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 100 = 99")
def malformed_feeds(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.malformed_feeds(_feed_documents(spark, folder), "body").select("o_orderkey")


@query("""
WITH items AS (
  SELECT o_orderkey, 0 AS item_position, 'https://shop.example.org/o/' || o_orderkey AS canonical_url, 'Order' || chr(10) || '  ' || o_orderkey || ' &amp; more' AS title,
    'Remote  ' || o_orderpriority || '  design' AS description FROM orders),
more AS (SELECT o_orderkey, unnest(range(1, 26))::INT AS item_position FROM orders)
SELECT * FROM items UNION ALL SELECT o_orderkey, item_position, 'https://t.example.org/', 'T', '' FROM more WHERE item_position <> 13""")
def quick_feed_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Pattern scan of the same feeds, which also reads broken documents and any number of items."""
    longer = F.regexp_replace("xml", "(?s)(<item>.*?</item>)", "$1" + "<item><title>T</title><link>https://t.example.org/</link></item>" * 12)
    return feeds.first_items(derive(spark, folder, FEEDS).withColumn("xml", longer), "o_orderkey", "xml")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey * 10 + l_linenumber) <= 10")
def first_items_per_source(spark: SparkSession, folder: str) -> DataFrame:
    lines = derive(spark, folder, "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey * 10 + l_linenumber AS line FROM {lineitem}")
    return feeds.first_rows(lines, "l_suppkey", "line", 10).select("l_orderkey", "l_linenumber", "l_partkey")


ATOM_FEEDS = """
SELECT p_partkey, '<feed xmlns="http://www.w3.org/2005/Atom">' || CASE WHEN p_partkey % 9 = 8 THEN '' ELSE
  '<entry><id>http://arxiv.org/abs/' || CASE WHEN p_partkey % 7 = 0 THEN 'x' ELSE '2401.' END || CAST(10000 + p_partkey AS STRING) || 'v3</id><published>2024-01-05T0' || CAST(p_partkey % 10 AS STRING)
  || ':30:00Z</published><title> On
   ' || p_name || ' </title><summary>' || CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE p_brand END || '</summary><author><name>' || CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_type END
  || '</name></author><author><name>A. Other</name></author></entry>' END || '</feed>' AS xml
FROM {part}
"""


@query("""
SELECT p_partkey, 'https://arxiv.org/abs/2401.' || (10000 + p_partkey) AS paper_url, 'On ' || p_name AS title, p_type || '; A. Other' AS authors,
  strftime(TIMESTAMP '2024-01-05 00:30:00' + to_hours(p_partkey % 10), '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at, CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS abstract
FROM part WHERE p_partkey % 9 <> 8 AND p_partkey % 7 <> 0 AND p_partkey % 11 <> 0""")
def atom_papers(spark: SparkSession, folder: str) -> DataFrame:
    documents = derive(spark, folder, ATOM_FEEDS).select("p_partkey", F.encode("xml", "UTF-8").alias("body"))
    papers, _ = feeds.atom_papers(documents, "body")
    return papers.select(
        "p_partkey",
        "paper_url",
        "title",
        F.array_join("authors", "; ").alias("authors"),
        utc_text(F.col("published_at")).alias("published_at"),
        "abstract",
    )


@query("SELECT p_partkey FROM part WHERE p_partkey % 9 = 8 OR p_partkey % 7 = 0 OR p_partkey % 11 = 0")
def failed_atom_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = derive(spark, folder, ATOM_FEEDS).select("p_partkey", F.encode("xml", "UTF-8").alias("body"))
    return feeds.atom_papers(documents, "body")[1]


# Archive pages of two wrapped rows per order, with gaps and wrong types.
ARCHIVE_PAGES = """
SELECT o_orderkey, '{{"rows":[{{"row":{{"paper_url":"https://papers.example.org/paper/p' || CAST(o_orderkey AS STRING) || '/","paper_title":" Paper  ' || CAST(o_orderkey AS STRING)
  || '","paper_arxiv_id":"' || CAST(CAST(2401 + floor(o_orderkey / 90000) AS BIGINT) AS STRING) || '.' || CAST(10000 + o_orderkey % 90000 AS STRING) || '","paper_url_abs":"http://arxiv.org/abs/' || CAST(CAST(2401 + floor(o_orderkey / 90000) AS BIGINT) AS STRING) || '.' || CAST(10000 + o_orderkey % 90000 AS STRING)
  || 'v1","repo_url":' || CASE WHEN o_orderkey % 6 = 0 THEN 'null' ELSE '"https://github.com/c' || CAST(o_custkey AS STRING) || '/R"' END || ',"is_official":' || CASE WHEN o_orderkey % 4 = 0 THEN '"true"' ELSE 'true' END
  || ',"mentioned_in_paper":true,"framework":' || CASE WHEN o_orderkey % 2 = 0 THEN '"torch"' ELSE '5' END || '}}}},{{"row":[1]}},7,{{"row":{{"is_official":true}}}}]}}' AS body, o_custkey
FROM {orders}
"""


@query("""
SELECT o_orderkey, 'https://papers.example.org/paper/p' || o_orderkey AS canonical_url, 'https://arxiv.org/abs/' || (2401 + o_orderkey // 90000) || '.' || (10000 + o_orderkey % 90000) AS paper_url,
  'Paper ' || o_orderkey AS title, 'https://github.com/c' || o_custkey || '/R' AS github_url, CASE WHEN o_orderkey % 2 = 0 THEN 'torch' END AS framework,
  true AS mentioned_in_paper, false AS mentioned_in_github
FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 6 <> 0""")
def archive_candidates(spark: SparkSession, folder: str) -> DataFrame:
    rows = archive.archive_rows(derive(spark, folder, ARCHIVE_PAGES).select("o_orderkey", "body"), "body")
    return archive.archive_candidates(rows).select(
        "o_orderkey", "canonical_url", "paper_url", "title", "github_url", "framework", "mentioned_in_paper", "mentioned_in_github"
    )


@query("SELECT o_orderkey, unnest([0, 3]) AS row_position FROM orders")
def archive_row_positions(spark: SparkSession, folder: str) -> DataFrame:
    pages = derive(spark, folder, ARCHIVE_PAGES).select("o_orderkey", "body")
    return archive.archive_rows(pages, "body").select("o_orderkey", "row_position")


ORGANIZATION_PAGES = """
SELECT s_suppkey, '<html><!-- <script type="application/ld+json">{{"@type":"Organization"}}</script> --><script type="text/javascript">var a=1;</script><script id="x" type="application/ld+json">'
  || '{{"@graph":[{{"@type":"' || CASE s_suppkey % 4 WHEN 0 THEN 'Person' WHEN 1 THEN 'Corporation' ELSE 'Organization' END || '","name":" ' || s_name || ' ","url":"https://s.example.org/c/' || CAST(s_suppkey AS STRING)
  || '/?utm_source=d","description":"' || CASE WHEN s_suppkey % 3 = 0 THEN '  ' ELSE 'Makes things' END || '","address":' || CASE WHEN s_suppkey % 2 = 0 THEN '" Town "' ELSE '{{"addressLocality":"Town","streetAddress":" ","addressCountry":"N' || CAST(s_nationkey AS STRING) || '"}}' END
  || ',"foundingDate":' || CASE s_suppkey % 3 WHEN 0 THEN '"' || CAST(1700 + s_suppkey AS STRING) || '-04-01"' WHEN 1 THEN '1990' ELSE '"n/a"' END || ',"numberOfEmployees":' || CASE s_suppkey % 3 WHEN 0 THEN '{{"value":-1,"minValue":' || CAST(s_suppkey AS STRING) || '}}' WHEN 1 THEN '12' ELSE '"12"' END
  || '}},{{"@type":"Organization","name":"Again","url":"http://s.example.org/c/' || CAST(s_suppkey AS STRING) || '"}}]}}</script><script type="application/ld+json">{{broken</script></html>' AS html
FROM {supplier}
"""


@query("""
WITH read AS (
  SELECT s_suppkey, 'https://s.example.org/c/' || s_suppkey AS canonical_url, s_name AS entity_name, CASE WHEN s_suppkey % 3 <> 0 THEN 'Makes things' END AS description,
    CASE WHEN s_suppkey % 2 = 0 THEN 'Town' ELSE 'Town, N' || s_nationkey END AS headquarters,
    CASE s_suppkey % 3 WHEN 0 THEN CASE WHEN s_suppkey BETWEEN 100 AND 400 THEN 1700 + s_suppkey END WHEN 1 THEN 1990 END AS founded_year,
    CASE s_suppkey % 3 WHEN 0 THEN s_suppkey WHEN 1 THEN 12 END AS employee_count FROM supplier WHERE s_suppkey % 4 <> 0
  UNION ALL SELECT s_suppkey, 'https://s.example.org/c/' || s_suppkey, 'Again', NULL, NULL, NULL, NULL FROM supplier WHERE s_suppkey % 4 = 0)
SELECT * FROM read""")
def organization_candidates(spark: SparkSession, folder: str) -> DataFrame:
    found = directories.organization_candidates(derive(spark, folder, ORGANIZATION_PAGES), "html", "s_suppkey")
    return found.select("s_suppkey", "canonical_url", "entity_name", "description", "headquarters", "founded_year", "employee_count")


PRODUCT_PAGES = """
SELECT p_partkey, '<script type="application/ld+json">{{"@type":' || CASE p_partkey % 5 WHEN 0 THEN '["Thing","Product"]' WHEN 1 THEN '"WebApplication"' WHEN 2 THEN '"Offer"' ELSE '"Product"' END || ',"name":"' || p_name
  || '","url":"https://p.example.org/i/' || CAST(p_partkey AS STRING) || '",' || CASE p_partkey % 3 WHEN 0 THEN '"brand":{{"name":"' || p_brand || '"}}' WHEN 1 THEN '"brand":{{"name":" "}},"author":"' || p_type || '"' ELSE '"manufacturer":"' || p_brand || '"' END
  || CASE p_partkey % 9 WHEN 0 THEN ',"pricingModel":"freemium"' WHEN 1 THEN ',"isAccessibleForFree":true,"offers":{{"price":3}}' WHEN 2 THEN ',"offers":{{"price":0}}' WHEN 3 THEN ',"offers":[7,{{"price":"9"}},{{"price":" 0.00 "}}]'
    WHEN 4 THEN ',"offers":{{"price":' || CAST(p_retailprice AS STRING) || '}}' WHEN 5 THEN ',"offers":[{{"description":"For Enterprise teams","price":0}}]' WHEN 6 THEN ',"pricingModel":"other","offers":{{"description":"a freemium plan"}}'
    WHEN 7 THEN ',"isAccessibleForFree":"true"' ELSE ',"offers":[]' END || '}}</script>' AS html
FROM {part}
"""


@query("""
WITH priced AS (SELECT *, CASE p_partkey % 9 WHEN 0 THEN 'FREEMIUM' WHEN 1 THEN 'FREE' WHEN 2 THEN 'FREE' WHEN 3 THEN 'FREE' WHEN 4 THEN 'PAID' WHEN 5 THEN 'ENTERPRISE' WHEN 6 THEN 'FREEMIUM' END AS pricing_model FROM part)
SELECT p_partkey, 'https://p.example.org/i/' || p_partkey AS canonical_url, p_name AS product_name, CASE WHEN p_partkey % 3 = 1 THEN p_type ELSE p_brand END AS startup_name, pricing_model
FROM priced WHERE pricing_model IS NOT NULL AND p_partkey % 5 <> 2""")
def product_candidates(spark: SparkSession, folder: str) -> DataFrame:
    found = directories.product_candidates(derive(spark, folder, PRODUCT_PAGES), "html", "p_partkey")
    return found.select("p_partkey", "canonical_url", "product_name", "startup_name", "pricing_model")


HIT_PAGES = """
SELECT c_custkey, '{{"hits":[{{"name":" ' || c_name || ' ",' || CASE c_custkey % 3 WHEN 0 THEN '"website":"http://c.example.org/' || CAST(c_custkey AS STRING) || '",' WHEN 1 THEN '"slug":"c-' || CAST(c_custkey AS STRING) || '",' ELSE '"website":"nowhere",' END
  || '"team_size":' || CASE c_custkey % 4 WHEN 0 THEN CAST(c_nationkey AS STRING) WHEN 1 THEN '-1' WHEN 2 THEN '"9"' ELSE '7.9' END || ',"long_description":"","one_liner":"' || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END
  || '","all_locations":"Town"}},{{"name":null,"website":"http://c.example.org/x"}},{{"name":"Same","website":"https://c.example.org/' || CAST(c_custkey AS STRING) || '/"}}]}}' AS body
FROM {customer}
"""


@query("""
WITH read AS (
  SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'https://c.example.org/' || c_custkey ELSE 'https://www.ycombinator.com/companies/c-' || c_custkey END AS canonical_url, c_name AS entity_name,
    CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS description, 'Town' AS headquarters, CASE c_custkey % 4 WHEN 0 THEN c_nationkey WHEN 3 THEN 7 END AS employee_count FROM customer WHERE c_custkey % 3 <> 2
  UNION ALL SELECT c_custkey, 'https://c.example.org/' || c_custkey, 'Same', NULL, NULL, NULL FROM customer WHERE c_custkey % 3 <> 0)
SELECT * FROM read""")
def search_hits(spark: SparkSession, folder: str) -> DataFrame:
    found = directories.search_hits(derive(spark, folder, HIT_PAGES), "body", "c_custkey")
    return found.select("c_custkey", "canonical_url", "entity_name", "description", "headquarters", "employee_count")


CARD_PAGES = """
SELECT p_partkey, '<ul><LI data-x="1" class="box ai_item big"><div><a class="l" href="' || CASE WHEN p_partkey % 2 = 0 THEN '/ai/' ELSE 'http://ext.example.org/' END || CAST(p_partkey AS STRING) || '"><img></a><h2 class="t"> ' || p_name
  || ' </h2><span>' || CASE p_partkey % 6 WHEN 0 THEN 'Freemium' WHEN 1 THEN 'free trial' WHEN 2 THEN 'Paid plans' WHEN 3 THEN 'See PRICING' WHEN 4 THEN 'Contact us' ELSE 'Plan' END || '</span>'
  || CASE WHEN p_partkey % 3 = 0 THEN '<p class="x desc"> ' || p_type || ' </p>' ELSE '' END || '</div></li><li class="other"><a href="/no"></a><h2>No</h2></li></ul>' AS html
FROM {part}
"""


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'https://theresanaiforthat.com/ai/' ELSE 'https://ext.example.org/' END || p_partkey AS canonical_url, p_name AS product_name,
  CASE p_partkey % 6 WHEN 0 THEN 'FREE' WHEN 2 THEN 'PAID' WHEN 3 THEN 'PAID' WHEN 4 THEN 'ENTERPRISE' ELSE 'FREEMIUM' END AS pricing_model,
  CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_name || ' AI tool' END AS description FROM part""")
def directory_cards(spark: SparkSession, folder: str) -> DataFrame:
    found = directories.directory_cards(derive(spark, folder, CARD_PAGES), "html", "p_partkey")
    return found.select("p_partkey", "canonical_url", "product_name", "pricing_model", "description")


TITLES = """
SELECT doc_id, text || CASE doc_id % 9 WHEN 0 THEN ' Remote ENGINEER' WHEN 1 THEN ' Researcher, product' WHEN 2 THEN ' UX Designer (remote)' WHEN 3 THEN ' Sales' WHEN 4 THEN ' marketing'
  WHEN 5 THEN ' Product trial, free' WHEN 6 THEN ' paid pricing' WHEN 7 THEN ' enterprise' ELSE '' END AS words
FROM {documents}
"""


@query(f"""WITH raw AS ({plain(TITLES)}), low AS (SELECT doc_id, lower(words) AS w FROM raw)
SELECT doc_id, contains(w, 'remote') AS is_remote, CASE WHEN contains(w, 'engineer') THEN 'Engineering' WHEN contains(w, 'research') THEN 'Research' WHEN contains(w, 'design') THEN 'Design'
  WHEN contains(w, 'sales') THEN 'Sales' WHEN contains(w, 'marketing') THEN 'Marketing' WHEN contains(w, 'product') THEN 'Product' END AS role_family,
  CASE WHEN contains(w, 'free') AND NOT contains(w, 'trial') THEN 'FREE' WHEN contains(w, 'paid') OR contains(w, 'pricing') THEN 'PAID'
    WHEN contains(w, 'enterprise') OR contains(w, 'contact') THEN 'ENTERPRISE' ELSE 'FREEMIUM' END AS pricing_model FROM low""")
def keyword_rules(spark: SparkSession, folder: str) -> DataFrame:
    folded = stage(parallel(derive(spark, folder, TITLES)), {"words": casefold(F.col("words"))})
    words = F.col("words")
    return folded.select(
        "doc_id", is_remote(words).alias("is_remote"), role_family(words).alias("role_family"), card_pricing(words).alias("pricing_model")
    )
