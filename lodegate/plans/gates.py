"""Freshness gate, its counters, watermarks and date parsing over events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.functions.binding import stage
from lodegate.functions.dates import (
    date_evidence,
    evidence_timestamp,
    mentioned_relative_timestamp,
    page_timestamp,
    relative_timestamp,
    retry_after_seconds,
    utc_text,
)
from lodegate.operators.freshness import (
    advance_watermarks,
    freshness_decision,
    gate_summary,
    reason_counts,
    reason_map,
    since_watermark,
)
from lodegate.plans.registry import derive, plain, query
from lodegate.scale import parallel

NOW = "2024-01-30 12:00:00"
def _now():
    return F.lit(NOW + "+00:00").cast("timestamp")


# Events as candidates: the event type is the source, the user decides where the date came from.
CANDIDATES = """
SELECT event_id, event_type AS source_id, user_id,
  CASE WHEN user_id % 11 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS published_at,
  CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 4 = 0 THEN 'json_ld' WHEN user_id % 4 = 1 THEN 'visible'
    WHEN user_id % 4 = 2 THEN 'rss' ELSE 'time' END AS date_source,
  CAST(CASE WHEN user_id % 11 = 0 THEN 0.0 WHEN user_id % 4 = 0 THEN 0.99 WHEN user_id % 4 = 1 THEN 0.70
    WHEN user_id % 4 = 2 THEN 0.75 ELSE 0.90 END AS DOUBLE) AS date_confidence
FROM {events}
"""

DECIDED_SQL = f"""
candidates AS ({plain(CANDIDATES)}),
aged AS (SELECT *, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(published_at)) / 1000000.0::DOUBLE / 3600.0::DOUBLE AS age_hours FROM candidates),
decided AS (SELECT *, CASE WHEN published_at IS NULL THEN 'date_unresolved' WHEN date_confidence < 0.75 THEN 'low_confidence_date'
    WHEN age_hours < 0 THEN 'future_date' WHEN age_hours > 24 THEN 'stale_date' ELSE 'fresh' END AS reason FROM aged),
final AS (SELECT *, CASE reason WHEN 'fresh' THEN 'ACCEPT' WHEN 'future_date' THEN 'REJECT' WHEN 'stale_date' THEN 'REJECT'
    ELSE 'QUARANTINE' END AS status FROM decided)
"""


def _decided(spark: SparkSession, folder: str) -> DataFrame:
    decision = freshness_decision(F.col("published_at"), F.col("date_source"), F.col("date_confidence"), _now())
    candidates = derive(spark, folder, CANDIDATES).withColumn("published_at", F.col("published_at").cast("timestamp"))
    return candidates.select("event_id", "source_id", "user_id", decision.alias("d")).select(
        "event_id", "source_id", "user_id", "d.*"
    )


@query(f"WITH {DECIDED_SQL} SELECT event_id, status, reason, date_source AS source, date_confidence AS confidence, age_hours FROM final")
def freshness_gate(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(spark, folder).select("event_id", "status", "reason", "source", "confidence", "age_hours")


@query(f"WITH {DECIDED_SQL} SELECT source_id, reason, count(*) AS records FROM final GROUP BY ALL")
def freshness_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return reason_counts(_decided(spark, folder), ["source_id"])


@query(f"""WITH {DECIDED_SQL}, counted AS (SELECT source_id, reason, count(*) AS n FROM final GROUP BY ALL)
SELECT source_id, string_agg(reason || '=' || n, ',' ORDER BY reason) AS reasons FROM counted GROUP BY source_id""")
def freshness_reason_map(spark: SparkSession, folder: str) -> DataFrame:
    entries = F.map_entries("reasons")
    shown = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return reason_map(_decided(spark, folder), "source_id").select("source_id", shown.alias("reasons"))


@query(f"""WITH {DECIDED_SQL},
claims AS (SELECT *, status <> 'ACCEPT' OR row_number() OVER (PARTITION BY source_id, user_id, status ORDER BY event_id) = 1 AS claimed FROM final)
SELECT source_id, count(*) AS parsed, count(*) FILTER (status = 'ACCEPT' AND claimed) AS accepted,
  count(*) FILTER (status = 'REJECT') AS rejected, count(*) FILTER (status = 'QUARANTINE') AS quarantined,
  count(*) FILTER (status = 'ACCEPT' AND NOT claimed) AS duplicates
FROM claims GROUP BY ROLLUP (source_id)""")
def freshness_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Counters per source and in total; a user's first accepted event per source is kept."""
    decided = _decided(spark, folder)
    firsts = (
        decided.filter("status = 'ACCEPT'").groupBy("source_id", "user_id").agg(F.min("event_id").alias("event_id"))
        .select("event_id", F.lit(True).alias("first"))
    )
    claimed = decided.join(firsts, "event_id", "left").withColumn(
        "claimed", (F.col("status") != "ACCEPT") | F.coalesce("first", F.lit(False))
    )
    return gate_summary(claimed, "source_id")


STORED_SQL = "SELECT source_id, max(published_at) AS watermark FROM final WHERE user_id % 4 = 2 AND reason = 'stale_date' GROUP BY source_id"


def _stored(decided: DataFrame) -> DataFrame:
    old = decided.filter("user_id % 4 = 2 AND reason = 'stale_date'")
    return old.groupBy("source_id").agg(F.max("published_at").alias("watermark"))


@query(f"""WITH {DECIDED_SQL}, stored AS ({STORED_SQL}),
latest AS (SELECT source_id, max(published_at) AS watermark FROM final WHERE status = 'ACCEPT' GROUP BY source_id)
SELECT source_id, strftime(max(watermark), '%Y-%m-%dT%H:%M:%S.%fZ') AS watermark
FROM (SELECT * FROM stored UNION ALL SELECT * FROM latest) GROUP BY source_id""")
def source_watermarks(spark: SparkSession, folder: str) -> DataFrame:
    decided = _decided(spark, folder)
    moved = advance_watermarks(_stored(decided), decided.filter("status = 'ACCEPT'"), "source_id", "published_at")
    return moved.withColumn("watermark", utc_text(F.col("watermark")))


@query(f"""WITH {DECIDED_SQL}, stored AS ({STORED_SQL})
SELECT event_id, f.source_id FROM final f LEFT JOIN stored s ON f.source_id = s.source_id
WHERE published_at IS NOT NULL AND (watermark IS NULL OR published_at > watermark)""")
def rows_since_watermark(spark: SparkSession, folder: str) -> DataFrame:
    decided = _decided(spark, folder).filter(F.col("published_at").isNotNull())
    return since_watermark(decided, _stored(decided), "source_id", "published_at").select("event_id", "source_id")


# Order dates written in the notations that sources use, and some that none accepts.
WRITTEN_DATES = """
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS dated, o_orderkey % 24 AS hh, o_orderkey % 60 AS mi,
  CAST(year(o_orderdate) AS STRING) AS yyyy, right('0' || CAST(month(o_orderdate) AS STRING), 2) AS mm,
  right('0' || CAST(day(o_orderdate) AS STRING), 2) AS dd, CAST(day(o_orderdate) AS STRING) AS d,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(o_orderdate) * 3 - 2, 3) AS mon,
  right('0' || CAST(o_orderkey % 24 AS STRING), 2) || ':' || right('0' || CAST(o_orderkey % 60 AS STRING), 2) AS hhmi
FROM {orders}
"""
WRITTEN = f"""
SELECT o_orderkey, dated, hh, mi, CASE o_orderkey % 13
  WHEN 0 THEN yyyy || '-' || mm || '-' || dd || 'T' || hhmi || ':07Z'
  WHEN 1 THEN yyyy || '-' || mm || '-' || dd
  WHEN 2 THEN yyyy || mm || dd || 'T' || replace(hhmi, ':', '') || '09'
  WHEN 3 THEN yyyy || '-' || mm || '-' || dd || ' ' || hhmi || ':30.250+05:30'
  WHEN 4 THEN 'Fri, ' || dd || ' ' || mon || ' ' || yyyy || ' ' || hhmi || ':00 GMT'
  WHEN 5 THEN d || ' ' || mon || ' ' || yyyy || ' ' || hhmi || ' EST'
  WHEN 6 THEN 'Mon, ' || d || ' ' || mon || ' ' || yyyy || ' ' || hhmi || ':59 -0330'
  WHEN 7 THEN mon || ' ' || d || ', ' || yyyy
  WHEN 8 THEN d || ' ' || mon || ' ' || yyyy
  WHEN 9 THEN yyyy || '-' || mm || '-31'
  WHEN 10 THEN 'Posted ' || d || ' hours ago'
  WHEN 11 THEN '  '
  ELSE mon || ' ' || d END AS raw
FROM ({WRITTEN_DATES}) w
"""
_DAY = "date_trunc('day', dated)"
_CLOCK = f"{_DAY} + to_hours(hh::INT) + to_minutes(mi::INT)"
_MONTH_END = "CASE WHEN month(dated) IN (1, 3, 5, 7, 8, 10, 12) THEN last_day(dated)::TIMESTAMP END"


@query(f"""
WITH written AS ({plain(WRITTEN)}),
parsed AS (SELECT o_orderkey, raw, CASE o_orderkey % 13
  WHEN 0 THEN {_CLOCK} + INTERVAL 7 SECOND WHEN 1 THEN {_DAY} WHEN 2 THEN {_CLOCK} + INTERVAL 9 SECOND
  WHEN 3 THEN {_CLOCK} + INTERVAL 30250 MILLISECOND - INTERVAL 330 MINUTE WHEN 4 THEN {_CLOCK}
  WHEN 5 THEN {_CLOCK} + INTERVAL 5 HOUR WHEN 6 THEN {_CLOCK} + INTERVAL 59 SECOND + INTERVAL 210 MINUTE
  WHEN 7 THEN {_DAY} WHEN 9 THEN {_MONTH_END}
  WHEN 12 THEN try_cast('2024-' || strftime(dated, '%m-%d') AS TIMESTAMP) END AS evidence_at, CASE o_orderkey % 13
  WHEN 0 THEN {_CLOCK} + INTERVAL 7 SECOND WHEN 1 THEN {_DAY} WHEN 2 THEN {_CLOCK} + INTERVAL 9 SECOND
  WHEN 3 THEN {_CLOCK} + INTERVAL 30250 MILLISECOND - INTERVAL 330 MINUTE
  WHEN 6 THEN {_CLOCK} + INTERVAL 59 SECOND + INTERVAL 210 MINUTE
  WHEN 7 THEN CASE WHEN month(dated) = 5 THEN {_DAY} END WHEN 8 THEN {_DAY} WHEN 9 THEN {_MONTH_END} END AS page_at FROM written)
SELECT o_orderkey, raw, strftime(evidence_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS evidence_at,
  strftime(page_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS page_at FROM parsed""")
def parsed_dates(spark: SparkSession, folder: str) -> DataFrame:
    return parallel(derive(spark, folder, WRITTEN)).select(
        "o_orderkey",
        "raw",
        utc_text(evidence_timestamp(F.col("raw"), _now())).alias("evidence_at"),
        utc_text(page_timestamp(F.col("raw"))).alias("page_at"),
    )


AGO = """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'yesterday' WHEN 1 THEN CAST(user_id AS STRING) || ' Hours ago'
  WHEN 2 THEN '1 minute  ago' WHEN 3 THEN 'Updated ' || CAST(user_id AS STRING) || ' days ago by staff'
  WHEN 4 THEN CASE WHEN event_id % 5 = 0 THEN 'seen 10000000005 days ago' ELSE CAST(user_id AS STRING) || ' weeks ago' END ELSE CAST(user_id AS STRING) || ' days ago' END AS raw, user_id AS n
FROM {events}
"""


@query(f"""
WITH raw AS ({plain(AGO)}),
told AS (SELECT *, CASE event_id % 6 WHEN 0 THEN to_days(1) WHEN 1 THEN to_hours(n) WHEN 2 THEN to_minutes(1) WHEN 5 THEN to_days(n::INT) END AS whole,
  CASE event_id % 6 WHEN 1 THEN to_hours(n) WHEN 2 THEN to_minutes(1) WHEN 3 THEN to_days(n::INT) WHEN 5 THEN to_days(n::INT) END AS inside FROM raw)
SELECT event_id, raw, strftime(TIMESTAMP '{NOW}' - whole, '%Y-%m-%dT%H:%M:%S.%fZ') AS whole_text_at,
  strftime(TIMESTAMP '{NOW}' - inside, '%Y-%m-%dT%H:%M:%S.%fZ') AS mentioned_at FROM told""")
def relative_dates(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.col("raw")
    return derive(spark, folder, AGO).select(
        "event_id",
        "raw",
        utc_text(relative_timestamp(raw, _now())).alias("whole_text_at"),
        utc_text(mentioned_relative_timestamp(raw, _now())).alias("mentioned_at"),
    )


EVIDENCE = """
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS dated,
  CASE WHEN o_orderkey % 7 = 0 THEN 'not a date' WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS STRING) END AS json_ld,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS meta,
  CASE WHEN o_orderkey % 3 = 0 THEN replace(CAST(o_orderdate AS STRING), ' ', 'T') || 'Z' WHEN o_orderkey % 3 = 1 THEN '' END AS time,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T06:00:00+06:00' END AS rss,
  CASE WHEN o_orderkey % 11 < 8 THEN '1 day ago' END AS relative
FROM {orders}
"""


@query(f"""
WITH raw AS ({plain(EVIDENCE)}),
chosen AS (SELECT o_orderkey, dated, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0 THEN 'json_ld' WHEN o_orderkey % 4 = 0 THEN 'meta'
  WHEN o_orderkey % 3 = 0 THEN 'time' WHEN o_orderkey % 2 = 0 THEN 'rss' WHEN o_orderkey % 11 < 8 THEN 'relative' END AS source FROM raw)
SELECT o_orderkey, source, strftime(CASE WHEN source = 'relative' THEN TIMESTAMP '2024-01-29 12:00:00' WHEN source IS NOT NULL THEN dated END,
  '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at,
  CAST(CASE source WHEN 'json_ld' THEN 0.99 WHEN 'meta' THEN 0.95 WHEN 'time' THEN 0.90 WHEN 'rss' THEN 0.85 WHEN 'relative' THEN 0.60 ELSE 0 END AS DOUBLE) AS confidence
FROM chosen""")
def date_priority(spark: SparkSession, folder: str) -> DataFrame:
    sources = ("json_ld", "meta", "time", "rss", "relative")
    chosen = date_evidence(_now(), **{name: F.col(name) for name in sources})
    return stage(parallel(derive(spark, folder, EVIDENCE)).select("o_orderkey", *sources), {"e": chosen}).select(
        "o_orderkey", "e.source", utc_text(F.col("e.published_at")).alias("published_at"), "e.confidence"
    )


HEADERS = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN CAST(user_id AS STRING) WHEN 1 THEN ' ' || CAST(value AS STRING) || ' ' WHEN 2 THEN '-3'
  WHEN 3 THEN 'Tue, 30 Jan 2024 ' || right('0' || CAST(user_id % 24 AS STRING), 2) || ':15:00 GMT' ELSE CASE WHEN event_id % 2 = 0 THEN '5d' ELSE 'soon' END END AS header, user_id, value
FROM {events}
"""


@query(f"""WITH raw AS ({plain(HEADERS)})
SELECT event_id, header, CASE event_id % 5 WHEN 0 THEN user_id::DOUBLE WHEN 1 THEN greatest(0.0, value) WHEN 2 THEN 0.0
  WHEN 3 THEN greatest(0.0, (user_id % 24 - 12) * 3600.0 + 900.0)::DOUBLE END AS seconds FROM raw""")
def retry_after(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, HEADERS).select(
        "event_id", "header", retry_after_seconds(F.col("header"), _now()).alias("seconds")
    )
