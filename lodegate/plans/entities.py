"""Entity resolution over suppliers, customers and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.functions.text import entity_key
from lodegate.operators.entities import (
    alias_conflicts as conflicting_aliases,
    alias_index,
    latest_mappings,
    mapping_rows,
    resolve,
    resolved_name,
)
from lodegate.plans.registry import derive, plain, query
from lodegate.scale import lookup_join

NAMES = """
SELECT c_custkey, c_name || CASE c_custkey % 10 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' LLC' WHEN 2 THEN ' & Co' WHEN 3 THEN ' Ltd. Company' WHEN 4 THEN ' Mistrál-AI GmbH'
  WHEN 5 THEN ' Incorporated of ' || c_mktsegment WHEN 6 THEN '' WHEN 7 THEN ' Straße Corp' WHEN 8 THEN ' (Limited) plc' ELSE ' Fiancé_ﬁrm' END AS name
FROM {customer}
"""

_KEY_SQL = """regexp_replace(regexp_replace(trim(regexp_replace(replace(lower(strip_accents(replace(replace({0}, 'ß', 'ss'), 'ﬁ', 'fi'))), '&', ' and '), '[^a-z0-9]+', ' ', 'g')),
  '((^| )(inc|incorporated|llc|ltd|limited|corp|corporation|co|company|plc|gmbh))+$', ''), ' ', '', 'g')"""


@query(f"WITH raw AS ({plain(NAMES)}) SELECT c_custkey, name, {_KEY_SQL.format('name')} AS entity_key FROM raw")
def entity_keys(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, NAMES).withColumn("entity_key", entity_key(F.col("name")))


# Suppliers as known entities; every seventh shares an alias with its neighbour.
SEEDS = """
SELECT 'supplier:' || CAST(s_suppkey AS STRING) AS entity_id, s_name AS canonical_name, 'Vendor ' || CAST(s_suppkey AS STRING) AS alias,
  CASE WHEN s_suppkey % 7 < 2 THEN 'Shared ' || CAST(CAST(floor(s_suppkey / 7) AS BIGINT) AS STRING) || ' Ltd' END AS shared
FROM {supplier}
"""


def _seeds(spark: SparkSession, folder: str, shared: bool = False) -> DataFrame:
    aliases = F.array_compact(F.array("alias", "shared")) if shared else F.array("alias")
    return derive(spark, folder, SEEDS).select("entity_id", "canonical_name", aliases.alias("aliases"))


@query(f"""WITH raw AS ({plain(SEEDS)}), names AS (SELECT entity_id, canonical_name AS name FROM raw UNION SELECT entity_id, alias FROM raw UNION SELECT entity_id, shared FROM raw WHERE shared IS NOT NULL),
keys AS (SELECT DISTINCT {_KEY_SQL.format('name')} AS entity_key, entity_id FROM names)
SELECT entity_key, count(*) AS entities, min(entity_id) AS first_entity, max(entity_id) AS last_entity FROM keys WHERE entity_key <> '' GROUP BY entity_key HAVING count(*) > 1""")
def alias_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return conflicting_aliases(_seeds(spark, folder, shared=True))


# Mentions on every line: exact spellings, an alias, longer names and unknown ones.
MENTIONS = """
SELECT l_orderkey * 10 + l_linenumber AS mention_id, l_suppkey, l_linenumber, s_name,
  CASE l_linenumber WHEN 1 THEN upper(replace(s_name, '#', ' ')) || ', Inc.' WHEN 2 THEN 'Vendor ' || CAST(l_suppkey AS STRING) || ' LLC' WHEN 3 THEN s_name || ' Labs' WHEN 4 THEN s_name || 'x Company'
    WHEN 5 THEN 'QQ WW' WHEN 6 THEN '   ' ELSE s_name END AS name
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
"""

_MENTION_SQL = f"""
raw AS ({plain(MENTIONS)}),
told AS (SELECT *, CASE WHEN l_linenumber IN (3, 4) THEN 'fuzzy' WHEN l_linenumber IN (5, 6) THEN 'unresolved' ELSE 'exact' END AS method,
  CASE l_linenumber WHEN 3 THEN 34.0 / 38.0 WHEN 4 THEN 34.0 / 35.0 WHEN 5 THEN 0.0 WHEN 6 THEN 0.0 ELSE 1.0 END::DOUBLE AS confidence FROM raw),
final AS (SELECT *, CASE WHEN confidence >= 0.95 THEN 'AUTO_MATCH' WHEN confidence >= 0.8 THEN 'REVIEW' ELSE 'UNRESOLVED' END AS status FROM told)
"""


@query(f"""WITH raw AS ({plain(MENTIONS)})
SELECT mention_id, CASE WHEN l_linenumber IN (1, 2, 7) THEN 'supplier:' || l_suppkey END AS entity_id FROM raw""")
def exact_entities(spark: SparkSession, folder: str) -> DataFrame:
    aliases = alias_index(_seeds(spark, folder))
    mentions = derive(spark, folder, MENTIONS).select("mention_id", entity_key(F.col("name")).alias("entity_key"))
    return lookup_join(mentions, aliases, ["entity_key"], "left", spread=F.col("mention_id")).select("mention_id", "entity_id")


def _resolved(spark: SparkSession, folder: str) -> DataFrame:
    return resolve(derive(spark, folder, MENTIONS), "name", _seeds(spark, folder), spread=F.col("mention_id"))


@query(f"""WITH {_MENTION_SQL}
SELECT mention_id, method, confidence, status, CASE WHEN method <> 'unresolved' THEN 'supplier:' || l_suppkey END AS canonical_entity_id,
  CASE WHEN status = 'AUTO_MATCH' THEN s_name ELSE name END AS shown_name FROM final""")
def entity_resolution(spark: SparkSession, folder: str) -> DataFrame:
    resolved = _resolved(spark, folder)
    shown = resolved_name(F.col("name"), F.col("canonical_name"), F.col("status"))
    return resolved.select("mention_id", "method", "confidence", "status", "canonical_entity_id", shown.alias("shown_name"))


@query(f"""WITH {_MENTION_SQL}
SELECT name AS raw_name, 'source' || (mention_id % 3) AS source, max(mention_id) AS record_id, arg_max(status, mention_id) AS status FROM final GROUP BY ALL""")
def latest_entity_mappings(spark: SparkSession, folder: str) -> DataFrame:
    """Mapping log of all mentions, reduced to the last row per name and source."""
    source = F.concat(F.lit("source"), (F.col("mention_id") % 3).cast("string"))
    log = mapping_rows(_resolved(spark, folder), "name", source, F.col("mention_id"), F.lit(None).cast("timestamp"))
    return latest_mappings(log, "recordId").select(
        F.col("rawName").alias("raw_name"), "source", F.col("recordId").alias("record_id"), "status"
    )
