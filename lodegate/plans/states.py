"""Rate limits, circuit breakers and streaming runs over the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.functions.dates import utc_text
from lodegate.functions.identity import content_hash, record_id
from lodegate.operators.limits import circuit_breaker, token_bucket
from lodegate.plans.gates import DECIDED_SQL, _now
from lodegate.plans.registry import derive, plain, query, table
from lodegate.session import scratch_path
from lodegate.streaming.gate import ingest_stream, watermarks
from lodegate.streaming.queue import Handlers, decode_job, encode_job, run_workers

# Requests arrive in bursts: the time of an event is cut to the hour.
REQUESTS = """
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN ' Hot.example.org' WHEN user_id % 3 = 1 THEN 'hot.EXAMPLE.org' ELSE 'h' || CAST(user_id AS STRING) || '.example.org' END AS host, date_trunc('hour', ts) AS ts
FROM {events}
"""


@query(f"""
WITH raw AS ({plain(REQUESTS)}),
keyed AS (SELECT event_id, lower(trim(host)) AS h, epoch_us(ts) AS us FROM raw),
numbered AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY us, event_id) AS n FROM keyed),
shifted AS (SELECT *, max(us - (n - 1) * 300000000) OVER (PARTITION BY h ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS m FROM numbered)
SELECT event_id, greatest(us, (n - 4) * 300000000 + m)::DOUBLE AS granted_micros FROM shifted""")
def token_grants(spark: SparkSession, folder: str) -> DataFrame:
    """One token per five minutes and a burst of four; one host sends two thirds of the requests."""
    requests = derive(spark, folder, REQUESTS).withColumn("at_micros", F.unix_micros(F.col("ts").cast("timestamp")))
    granted = token_bucket(requests, "host", "at_micros", "event_id", rate_per_second=1 / 300, burst=4)
    return granted.select("event_id", "granted_micros")


CALLS = """
SELECT event_id, 'provider' || CAST(user_id % 7 AS STRING) AS provider, ts, event_type IN ('error', 'signup') AS failed FROM {events}
"""


@query(f"""
WITH raw AS ({plain(CALLS)}),
logs AS (SELECT provider, list({{'id': event_id, 'us': epoch_us(ts), 'bad': failed, 'f': 0, 'open': NULL::BIGINT, 'out': []::STRUCT(id BIGINT, allowed BOOLEAN, state VARCHAR, failures INTEGER)[]}} ORDER BY ts, event_id) AS calls FROM raw GROUP BY provider),
played AS (SELECT provider, list_reduce(calls, lambda a, x: CASE
    WHEN a.open IS NOT NULL AND x.us - a.open < 7200000000 THEN {{'id': 0, 'us': 0, 'bad': false, 'f': a.f, 'open': a.open, 'out': list_append(a.out, {{'id': x.id, 'allowed': false, 'state': 'OPEN', 'failures': a.f}})}}
    WHEN NOT x.bad THEN {{'id': 0, 'us': 0, 'bad': false, 'f': 0, 'open': NULL, 'out': list_append(a.out, {{'id': x.id, 'allowed': true, 'state': 'CLOSED', 'failures': 0}})}}
    WHEN a.open IS NOT NULL THEN {{'id': 0, 'us': 0, 'bad': false, 'f': a.f, 'open': x.us, 'out': list_append(a.out, {{'id': x.id, 'allowed': true, 'state': 'OPEN', 'failures': a.f}})}}
    WHEN a.f + 1 >= 3 THEN {{'id': 0, 'us': 0, 'bad': false, 'f': a.f + 1, 'open': x.us, 'out': list_append(a.out, {{'id': x.id, 'allowed': true, 'state': 'OPEN', 'failures': a.f + 1}})}}
    ELSE {{'id': 0, 'us': 0, 'bad': false, 'f': a.f + 1, 'open': NULL, 'out': list_append(a.out, {{'id': x.id, 'allowed': true, 'state': 'CLOSED', 'failures': a.f + 1}})}} END,
    {{'id': 0::BIGINT, 'us': 0::BIGINT, 'bad': false, 'f': 0, 'open': NULL::BIGINT, 'out': []::STRUCT(id BIGINT, allowed BOOLEAN, state VARCHAR, failures INTEGER)[]}}) AS final FROM logs),
told AS (SELECT unnest(final.out) AS c FROM played)
SELECT c.id AS event_id, c.allowed AS allowed, c.state AS state, c.failures AS failures FROM told""")
def breaker_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Three failures open a provider's circuit for two hours."""
    calls = derive(spark, folder, CALLS).withColumn("at_micros", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")
    played = circuit_breaker(
        calls, "provider", "at_micros", "event_id", "failed", threshold=3, cooldown_seconds=7200
    )
    return played.select("event_id", "allowed", "state", "failures")


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(folder)


def _candidate_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The candidates of the gate queries as a stream, with the keys they claim."""
    user = F.col("user_id")
    dated = user % 11 != 0
    by_user = lambda a, b, c, d: F.when(user % 4 == 0, a).when(user % 4 == 1, b).when(user % 4 == 2, c).otherwise(d)
    return _event_stream(spark, folder).select(
        F.col("event_id").alias("position"),
        F.col("event_type").alias("source_id"),
        F.when(dated, F.col("ts").cast("timestamp")).alias("published_at"),
        F.when(dated, by_user("json_ld", "visible", "rss", "time")).alias("date_source"),
        F.when(dated, by_user(0.99, 0.70, 0.75, 0.90)).otherwise(0.0).alias("date_confidence"),
        record_id(F.col("event_type"), (F.col("event_id") % 50).cast("string")).alias("url_key"),
        content_hash(user.cast("string")).alias("content_key"),
    )


def _ingested(spark: SparkSession, folder: str) -> str:
    state = scratch_path(spark, "stream")
    ingest_stream(_candidate_stream(spark, folder), state, _now()).awaitTermination()
    return state


_STREAM_SQL = f"""{DECIDED_SQL},
fresh AS (SELECT list({{'id': event_id, 'u': source_id || (event_id % 50), 'c': user_id::VARCHAR}} ORDER BY event_id) AS rows FROM final WHERE status = 'ACCEPT'),
folded AS (SELECT list_reduce(list_transform(rows, lambda r: {{'ids': [r.id], 'u': [r.u], 'c': [r.c]}}), lambda s, r: CASE WHEN list_contains(s.u, r.u[1]) OR list_contains(s.c, r.c[1]) THEN s
    ELSE {{'ids': list_concat(s.ids, r.ids), 'u': list_concat(s.u, r.u), 'c': list_concat(s.c, r.c)}} END, {{'ids': []::BIGINT[], 'u': []::VARCHAR[], 'c': []::VARCHAR[]}}) AS f FROM fresh),
won AS (SELECT unnest(f.ids) AS event_id FROM folded)
"""


@query(f"WITH {_STREAM_SQL} SELECT event_id AS position, status, reason, event_id IN (SELECT event_id FROM won) AS claimed FROM final")
def stream_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Gate and claim over a stream, read back after the input is used up."""
    decisions = spark.read.parquet(f"{_ingested(spark, folder)}/decisions")
    return decisions.select("position", "status", "reason", "claimed")


@query(f"""WITH {_STREAM_SQL}
SELECT source_id, strftime(max(published_at), '%Y-%m-%dT%H:%M:%S.%fZ') AS watermark FROM final WHERE event_id IN (SELECT event_id FROM won) GROUP BY source_id""")
def stream_watermarks(spark: SparkSession, folder: str) -> DataFrame:
    reached = watermarks(spark, _ingested(spark, folder), "source_id")
    return reached.withColumn("watermark", utc_text(F.col("watermark")))


def _jobs(events: DataFrame) -> DataFrame:
    types = F.array(*[F.lit(t) for t in ("FETCH_URL", "PARSE_DOCUMENT", "EXPORT_RECORD", "CLEAN_UP")])
    text = encode_job(
        F.col("event_id").cast("string"),
        F.get(types, (F.col("user_id") % 4).cast("int")),
        F.create_map(F.lit("type"), F.col("event_type")),
        (F.col("event_id") % 5).cast("int"),
    )
    return events.select(text.alias("job"))


@query("""
SELECT event_id, '{"attempts":' || (event_id % 5) || ',"job_id":"' || event_id || '","job_type":"' || ['FETCH_URL', 'PARSE_DOCUMENT', 'EXPORT_RECORD', 'CLEAN_UP'][user_id % 4 + 1] || '","payload":{"type":"' || event_type || '"}}' AS job,
  (event_id % 5)::INT AS attempts FROM events""")
def job_messages(spark: SparkSession, folder: str) -> DataFrame:
    encoded = _jobs(table(spark, folder, "events"))
    return encoded.select("job", decode_job(F.col("job")).alias("d")).select(
        F.col("d.job_id").cast("bigint").alias("event_id"), "job", F.col("d.attempts").alias("attempts")
    )


@query("""
WITH told AS (SELECT event_id, CASE WHEN user_id % 4 = 3 THEN 'dead_letters' WHEN event_type <> 'error' THEN 'processed' WHEN event_id % 5 >= 3 THEN 'dead_letters' ELSE 'retries' END AS place, user_id % 4 = 3 AS unknown, event_id % 5 AS n FROM events)
SELECT event_id::VARCHAR AS job_id, place, CASE WHEN place = 'dead_letters' THEN CASE WHEN unknown THEN 'unknown_job_type' ELSE 'max_retries:ConnectionError' END END AS reason,
  (CASE WHEN place = 'retries' THEN n + 1 ELSE n END)::INT AS attempts FROM told""")
def stream_workers(spark: SparkSession, folder: str) -> DataFrame:
    """Workers over a stream of jobs; jobs made from error events fail."""
    jobs = _jobs(_event_stream(spark, folder)).select(decode_job(F.col("job")).alias("d")).select("d.*")
    target = scratch_path(spark, "workers")
    failing = F.when(F.col("payload")["type"] == "error", "ConnectionError")
    handlers = Handlers()
    for job_type in ("FETCH_URL", "PARSE_DOCUMENT", "EXPORT_RECORD"):
        handlers.register(job_type, lambda rows: rows.withColumn("error_type", failing))
    run_workers(jobs, handlers, target).awaitTermination()
    none = F.lit(None).cast("string")
    parts = [
        spark.read.parquet(f"{target}/{place}").select(
            "job_id", F.lit(place).alias("place"), (F.col("reason") if place == "dead_letters" else none).alias("reason"), "attempts"
        )
        for place in ("processed", "retries", "dead_letters")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
