"""Addresses, record identities and duplicate prevention over pages and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.functions import identity
from lodegate.functions.binding import stage
from lodegate.functions.text import content_key_text
from lodegate.operators.dedupe import claim, claim_keys, duplicate_counts, merge_index, unseen
from lodegate.plans.registry import derive, plain, query, table
from lodegate.scale import first_per_key, parallel
from lodegate.session import materialize

# Spellings of every page address: as given, with credentials, with tracking
# and unordered parameters, with ports and odd characters, and one invalid.
URLS = """
SELECT page_id * 5 AS url_id, url FROM {pages}
UNION ALL SELECT page_id * 5 + 1, replace(replace(url, 'https://', 'HTTPS://u:p@'), 'http://', 'HTTP://u:p@WWW.') FROM {pages}
UNION ALL SELECT page_id * 5 + 2, replace(url, '#top', '') || CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END
  || 'z=' || CAST(page_id AS STRING) || '&utm_Campaign=x&a=%7Eb+c%26&FBCLID=9&&k&a=%C3%A9*(1)#part' FROM {pages}
UNION ALL SELECT page_id * 5 + 3, replace(replace(replace(url, '.com/', '.com:8443/a b/%zz/ü+~/'), '.net/', '.net:80//'), '.org/', '.org:443/%252F:@/') FROM {pages}
UNION ALL SELECT page_id * 5 + 4, CASE WHEN page_id % 3 = 0 THEN replace(url, 'http', 'ftp') WHEN page_id % 3 = 1 THEN 'https://?' || url
  ELSE replace(replace(replace(url, '.com/', '.com:99999/'), '.net/', '.net:8x/'), '.org/', '.org:/') END FROM {pages}
"""

CANONICAL_SQL = f"""
raw AS ({plain(URLS)}),
split AS (
  SELECT url_id, url,
    regexp_matches(url, '^(?i:https?)://[^/?#]*[^?#]*([?][^#]*)?(#.*)?$') AS shaped,
    regexp_replace(regexp_extract(url, '^(?i:https?)://([^/?#]*)', 1), '^.*@', '') AS authority,
    regexp_extract(url, '^(?i:https?)://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) AS search
  FROM raw),
parts AS (
  SELECT *, lower(regexp_extract(authority, '^([^:]*)', 1)) AS host, regexp_extract(authority, ':(.*)$', 1) AS port_text FROM split),
typed AS (SELECT *, try_cast(nullif(port_text, '') AS BIGINT) AS port FROM parts),
kept AS (
  SELECT *,
    replace(replace(replace(replace(url_encode(url_decode(CASE WHEN path = '' THEN '/' ELSE path END)), '%2F', '/'), '%3A', ':'), '%40', '@'), '%25', '%') AS clean,
    list_sort(list_filter(
      list_transform(list_filter(string_split(search, '&'), lambda s: s <> ''),
        lambda s: {{'k': url_decode(replace(regexp_extract(s, '^([^=]*)', 1), '+', ' ')), 'v': url_decode(replace(regexp_extract(s, '^[^=]*=(.*)$', 1), '+', ' '))}}),
      lambda p: lower(p.k) NOT IN ('fbclid', 'gclid', 'mc_cid', 'mc_eid') AND NOT starts_with(lower(p.k), 'utm_'))) AS pairs
  FROM typed),
canonical AS (
  SELECT url_id, url,
    CASE WHEN shaped AND host <> '' AND (port_text = '' OR (port IS NOT NULL AND port <= 65535)) THEN
      'https://' || host || CASE WHEN port IS NULL OR port IN (80, 443) THEN '' ELSE ':' || port::VARCHAR END
      || CASE WHEN clean = '/' THEN clean ELSE rtrim(clean, '/') END
      || CASE WHEN len(pairs) = 0 THEN '' ELSE '?' || array_to_string(list_transform(pairs,
           lambda p: replace(url_encode(p.k), '%20', '+') || '=' || replace(url_encode(p.v), '%20', '+')), '&') END
    END AS canonical_url
  FROM kept)
"""


@query(f"WITH {CANONICAL_SQL} SELECT url_id, url, canonical_url FROM canonical")
def canonical_url(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, URLS).withColumn("canonical_url", identity.canonical_url(F.col("url")))


@query(f"WITH {CANONICAL_SQL} SELECT url_id, canonical_url FROM canonical WHERE canonical_url IS NOT NULL "
       "QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY url_id) = 1")
def url_dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    return first_per_key(canonical_urls(spark, folder), ["canonical_url"], "url_id")


def canonical_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Every valid spelling of a page address with its canonical form."""
    valid = stage(
        derive(spark, folder, URLS),
        {"canonical_url": identity.canonical_url(F.col("url"))},
        keep=lambda r: r["canonical_url"].isNotNull(),
    )
    return valid.drop("url")


RESPONSES = """
SELECT page_id, url, html, 'pages' AS source_id,
  CASE page_id % 5 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'TEXT/HTML' WHEN 2 THEN 'application/atom+xml'
    WHEN 3 THEN 'image/png' END AS content_type,
  CAST('2026-09-01 22:15:00' AS TIMESTAMP) + page_id * INTERVAL '1' HOUR AS retrieved_at
FROM {pages}
"""


@query(f"""
WITH raw AS ({plain(RESPONSES)}),
links AS (SELECT *, 'https://' || regexp_extract(url, '^https?://([^/]*)', 1)
    || rtrim(regexp_extract(url, '^https?://[^/]*([^?#]*)', 1), '/')
    || CASE WHEN url LIKE '%?page=2&ref=x%' THEN '?page=2&ref=x' ELSE '' END AS canonical_url, sha256(html) AS content_hash FROM raw)
SELECT page_id, canonical_url, content_hash, sha256(source_id || chr(31) || canonical_url) AS record_id,
  sha256(source_id || chr(31) || canonical_url || chr(31) || content_hash) AS raw_document_id,
  source_id || '/' || strftime(retrieved_at, '%Y/%m/%d') || '/' || content_hash
    || CASE WHEN lower(split_part(content_type, ';', 1)) = 'text/html' THEN '.html'
            WHEN content_type = 'application/atom+xml' THEN '.xml' ELSE '.bin' END AS storage_key
FROM links""")
def raw_document_identity(spark: SparkSession, folder: str) -> DataFrame:
    source = F.col("source_id")
    keyed = stage(
        derive(spark, folder, RESPONSES),
        {"canonical_url": identity.canonical_url(F.col("url")), "content_hash": identity.content_hash(F.col("html"))},
    )
    return keyed.select(
        "page_id",
        "canonical_url",
        "content_hash",
        identity.record_id(source, F.col("canonical_url")).alias("record_id"),
        identity.raw_document_id(source, F.col("canonical_url"), F.col("content_hash")).alias("raw_document_id"),
        identity.storage_key(source, F.col("retrieved_at"), F.col("content_hash"), F.col("content_type")).alias("storage_key"),
    )


PAPER_LINKS = """
SELECT o_orderkey, CASE o_orderkey % 6
  WHEN 0 THEN 'http://arxiv.org/abs/' || CAST(2000 + o_orderkey % 600 AS STRING) || '.' || CAST(10000 + o_orderkey AS STRING) || 'v2'
  WHEN 1 THEN 'https://export.arxiv.org/abs/cs/' || CAST(1000000 + o_orderkey AS STRING) || '?utm_source=x'
  WHEN 2 THEN 'https://arxiv.org/pdf/2401.' || CAST(10000 + o_orderkey AS STRING)
  WHEN 3 THEN 'HTTPS://ARXIV.org/abs/2401.' || CAST(10000 + o_orderkey % 90000 AS STRING) || '/#s'
  WHEN 4 THEN 'https://arxiv.org/abs/math-ph/' || CAST(o_orderkey AS STRING)
  ELSE 'arxiv.org/abs/2401.12345' END AS url
FROM {orders}
"""


@query(f"""
WITH raw AS ({plain(PAPER_LINKS)}),
ids AS (SELECT *, regexp_extract(url, '^(?i:https?)://[^/?#]+/abs/([a-z-]+/[0-9]{{7}}|[0-9]{{4}}[.][0-9]{{4,5}})(v[0-9]+)?/*([?#].*)?$', 1) AS paper FROM raw)
SELECT o_orderkey, url, CASE WHEN paper <> '' THEN 'https://arxiv.org/abs/' || paper END AS paper_url FROM ids""")
def paper_url(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, PAPER_LINKS).withColumn("paper_url", identity.arxiv_url(F.col("url")))


REPOSITORY_LINKS = """
SELECT p_partkey, CASE p_partkey % 8
  WHEN 0 THEN 'HTTPS://WWW.GITHUB.COM/' || replace(p_brand, '#', '-') || '/' || replace(p_name, ' ', '-') || '.git/?utm_source=feed#readme'
  WHEN 1 THEN 'http://github.com:80/' || p_type || '//' || replace(p_name, ' ', '_') || '/'
  WHEN 2 THEN 'https://github.com/' || p_type
  WHEN 3 THEN 'https://github.com/' || p_type || '/' || p_type || '/issues'
  WHEN 4 THEN 'https://user@github.com/' || p_type || '/x'
  WHEN 5 THEN 'https://github.com:8080/' || p_type || '/x'
  WHEN 6 THEN 'https://gitlab.com/' || p_type || '/x'
  ELSE 'https://github.com/' || p_type || '/' || replace(p_brand, '#', '.') || '.git' END AS url
FROM {part}
"""


@query(f"""
WITH raw AS ({plain(REPOSITORY_LINKS)}),
split AS (SELECT *, lower(regexp_extract(url, '^(?i:https?)://([^/?#]*)', 1)) AS authority,
    list_filter(string_split(regexp_extract(url, '^(?i:https?)://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS names FROM raw),
checked AS (SELECT *, regexp_matches(authority, '^(www[.])?github[.]com(:(80|443)?)?$') AND len(names) = 2 AS usable,
    CASE WHEN names[2] LIKE '%.git' THEN left(names[2], length(names[2]) - 4) ELSE names[2] END AS name FROM split)
SELECT p_partkey, url, CASE WHEN usable THEN 'https://github.com/' || lower(names[1]) || '/' || lower(name) END AS repository_url,
  CASE WHEN usable THEN lower(names[1]) END AS owner, CASE WHEN usable THEN lower(name) END AS repository FROM checked""")
def repository_url(spark: SparkSession, folder: str) -> DataFrame:
    named = stage(derive(spark, folder, REPOSITORY_LINKS), {"repository_url": identity.repository_url(F.col("url"))})
    return named.withColumns(
        {
            "owner": identity.repository_owner(F.col("repository_url")),
            "repository": identity.repository_name(F.col("repository_url")),
        }
    )


# Python-style whitespace and case folding as far as the given texts use them.
FINGERPRINT_SQL = (
    "sha256(replace(lower(trim(regexp_replace(text, '[\\s\\p{Z}]+', ' ', 'g'))), 'ß', 'ss'))"
)


@query(f"SELECT doc_id, {FINGERPRINT_SQL} AS fingerprint FROM documents")
def content_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    documents = parallel(table(spark, folder, "documents").select("doc_id", "text"))
    return documents.select("doc_id", identity.content_hash(content_key_text(F.col("text"))).alias("fingerprint"))


@query(f"SELECT {FINGERPRINT_SQL} AS fingerprint, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def content_dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_counts(content_fingerprint(spark, folder), "fingerprint", "doc_id")


# Thirty addresses per source, so documents collide on address and on content.
ARRIVALS = """
SELECT doc_id, source AS source_id, 'http://' || source || '.example.org/item/' || CAST(doc_id % 30 AS STRING) || '?utm_medium=x' AS url, text
FROM {documents}
"""


def _arrival_keys(spark: SparkSession, folder: str) -> DataFrame:
    url_key, content_key = claim_keys(F.col("source_id"), F.col("url"), F.col("text"))
    arrivals = stage(parallel(derive(spark, folder, ARRIVALS)), {"url_key": url_key, "content_key": content_key})
    return arrivals.select("doc_id", "source_id", "url_key", "content_key")


ARRIVAL_SQL = f"""
arrivals AS (SELECT doc_id, source AS source_id,
    sha256(source || chr(31) || 'https://' || source || '.example.org/item/' || CAST(doc_id % 30 AS STRING)) AS url_key,
    {FINGERPRINT_SQL} AS content_key FROM documents)
"""


@query(f"""
WITH {ARRIVAL_SQL},
ordered AS (SELECT list({{'id': doc_id, 'u': url_key, 'c': content_key}} ORDER BY doc_id) AS rows FROM arrivals),
folded AS (SELECT list_reduce(rows, lambda state, r: CASE WHEN list_contains(state.u, r.u) OR list_contains(state.c, r.c) THEN state
    ELSE {{'ids': list_append(state.ids, r.id), 'u': list_append(state.u, r.u), 'c': list_append(state.c, r.c)}} END,
    {{'ids': []::BIGINT[], 'u': []::VARCHAR[], 'c': []::VARCHAR[]}}) AS final FROM
    (SELECT list_transform(rows, lambda r: {{'ids': [r.id], 'u': [r.u], 'c': [r.c], 'id': r.id}}) AS ignored, rows FROM ordered)),
won AS (SELECT unnest(final.ids) AS doc_id FROM folded)
SELECT doc_id, doc_id IN (SELECT doc_id FROM won) AS claimed FROM arrivals""")
def two_key_claim(spark: SparkSession, folder: str) -> DataFrame:
    arrivals = materialize(_arrival_keys(spark, folder), "arrivals")
    return claim(arrivals, "url_key", "content_key", "doc_id").select("doc_id", "claimed")


@query(f"""
WITH {ARRIVAL_SQL}, seen AS (SELECT DISTINCT content_key FROM arrivals WHERE doc_id % 3 = 0)
SELECT doc_id, content_key FROM arrivals WHERE doc_id % 3 <> 0 AND content_key NOT IN (SELECT content_key FROM seen)""")
def unseen_content(spark: SparkSession, folder: str) -> DataFrame:
    keys = _arrival_keys(spark, folder).select("doc_id", "content_key")
    earlier = keys.filter(F.col("doc_id") % 3 == 0)
    return unseen(keys.filter(F.col("doc_id") % 3 != 0), earlier, "content_key", "doc_id")


@query(f"WITH {ARRIVAL_SQL} SELECT DISTINCT url_key FROM arrivals")
def claimed_url_index(spark: SparkSession, folder: str) -> DataFrame:
    keys = _arrival_keys(spark, folder)
    stored = keys.filter(F.col("doc_id") % 3 == 0).select("url_key")
    return merge_index(stored, keys.filter(F.col("doc_id") % 3 != 0).select("url_key"))
