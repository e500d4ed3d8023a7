"""Chunks, prompts, answers, merging and folding of model extractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.functions import chunking
from lodegate.functions.binding import stage
from lodegate.functions.retrying import backoff_seconds, falls_back, is_transient_status, worker_outcome
from lodegate.functions.text import estimate_tokens, unfenced
from lodegate.operators import enrichment
from lodegate.operators.extraction import (
    INSTRUCTIONS,
    facts,
    fallback_order,
    fallback_result,
    labelled_text,
    merge_extractions,
    parsed_answer,
    prompt,
    provider_health,
    token_usage,
)
from lodegate.plans.registry import derive, plain, query, table
from lodegate.scale import parallel


@query("SELECT doc_id, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tokens FROM documents")
def token_estimates(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", estimate_tokens(F.col("text")).alias("tokens"))


@query("""
WITH cut AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') AS parts FROM documents)
SELECT doc_id, unnest(range(len(parts))) AS position, unnest(parts) AS sentence FROM cut""")
def sentence_split(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return documents.select("doc_id", F.posexplode(chunking.sentences(F.col("text"))).alias("position", "sentence"))


# Documents with a heading in front, a blank line after every fourth sentence
# end and a second heading in the middle.
HEADED = """
SELECT doc_id, '# Doc ' || CAST(doc_id AS STRING) || chr(10) || replace(replace(text, '. A', '.' || chr(10) || chr(10) || 'A'), '. T', '.' || chr(10) || '## Part T' || chr(10) || 'T') AS text
FROM {documents}
"""
HEADED_WITH_SOURCE = HEADED.replace("SELECT doc_id,", "SELECT doc_id, lang, source,")
TARGET = 60


def _size(text: str) -> str:
    return f"ceil(length({text}) / 4.0)::DOUBLE"


_OUT = "STRUCT(section VARCHAR, text VARCHAR)[]"
_FULL = f"(a.n > 0 AND a.n + {_size('x.text')} > {TARGET})"
_TEXT = f"CASE WHEN {_FULL} OR a.n = 0 THEN x.text ELSE a.text || chr(10) || chr(10) || x.text END"
_SECTION = f"CASE WHEN {_FULL} OR a.n = 0 THEN x.section ELSE coalesce(a.section, x.section) END"
_TOTAL = f"CASE WHEN {_FULL} THEN {_size('x.text')} ELSE a.n + {_size('x.text')} END"
_FLUSHED = f"CASE WHEN {_FULL} THEN list_append(a.out, {{'section': a.section, 'text': a.text}}) ELSE a.out END"

# Sequential folds over the lines, the sentences and the pieces of each document.
CHUNK_SQL = f"""
raw AS ({plain(HEADED)}),
lines AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda l: trim(l, ' ' || chr(9) || chr(13))) AS rows FROM raw),
marked AS (SELECT doc_id, unnest(rows) AS line, unnest(range(len(rows))) AS n FROM lines),
typed AS (SELECT *, regexp_matches(line, '^#{{1,6}}\\s') AS heading FROM marked),
grouped AS (SELECT *, sum(CASE WHEN heading OR line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS block,
  last_value(CASE WHEN heading THEN regexp_replace(line, '^#{{1,6}}\\s+', '') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS section FROM typed),
blocks AS (SELECT doc_id, block, any_value(section) AS section, string_agg(line, ' ' ORDER BY n) AS body FROM grouped WHERE NOT heading AND line <> '' GROUP BY doc_id, block),
sentences AS (SELECT doc_id, block, section, body, ceil(length(body) / 4.0) <= {TARGET} AS fits,
  list_filter(string_split(regexp_replace(body, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') AS parts FROM blocks),
split AS (SELECT doc_id, block, section, CASE WHEN fits THEN {{'text': body, 'out': []::VARCHAR[], 'n': 1.0::DOUBLE}} ELSE list_reduce(parts, lambda a, x: CASE
    WHEN {_size('x.text')} > {TARGET} THEN {{'text': '', 'out': list_concat(list_concat(a.out, CASE WHEN a.n > 0 THEN [a.text] ELSE []::VARCHAR[] END),
        list_transform(range(0, length(x.text), {TARGET * 4}), lambda i: substr(x.text, i + 1, {TARGET * 4}))), 'n': 0.0::DOUBLE}}
    WHEN a.n > 0 AND a.n + {_size('x.text')} > {TARGET} THEN {{'text': x.text, 'out': list_append(a.out, a.text), 'n': {_size('x.text')}}}
    ELSE {{'text': CASE WHEN a.n > 0 THEN a.text || ' ' || x.text ELSE x.text END, 'out': a.out, 'n': a.n + {_size('x.text')}}} END,
    {{'text': '', 'out': []::VARCHAR[], 'n': 0.0::DOUBLE}}) END AS state FROM
  (SELECT doc_id, block, section, body, fits, list_transform(parts, lambda s: {{'text': s, 'out': []::VARCHAR[], 'n': 0.0::DOUBLE}}) AS parts FROM sentences) s),
pieces AS (SELECT doc_id, block, section, list_concat(state.out, CASE WHEN state.n > 0 THEN [state.text] ELSE []::VARCHAR[] END) AS texts FROM split),
flat AS (SELECT doc_id, block, section, unnest(texts) AS text, unnest(range(len(texts))) AS p FROM pieces),
fed AS (SELECT doc_id, list({{'text': text, 'section': section, 'n': 0.0::DOUBLE, 'out': []::{_OUT}}} ORDER BY block, p) AS rows FROM flat GROUP BY doc_id),
packed AS (SELECT doc_id, list_reduce(rows, lambda a, x: CASE WHEN {_TOTAL} >= {TARGET}
    THEN {{'text': '', 'section': NULL::VARCHAR, 'n': 0.0::DOUBLE, 'out': list_append({_FLUSHED}, {{'section': {_SECTION}, 'text': {_TEXT}}})}}
    ELSE {{'text': {_TEXT}, 'section': {_SECTION}, 'n': {_TOTAL}, 'out': {_FLUSHED}}} END,
    {{'text': '', 'section': NULL::VARCHAR, 'n': 0.0::DOUBLE, 'out': []::{_OUT}}}) AS state FROM fed),
final AS (SELECT doc_id, list_concat(state.out, CASE WHEN state.n > 0 THEN [{{'section': state.section, 'text': state.text}}] ELSE []::{_OUT} END) AS chunks FROM packed),
told AS (SELECT doc_id, unnest(range(len(chunks))) AS sequence, unnest(chunks) AS chunk FROM final)
"""


@query(f"""WITH {CHUNK_SQL}
SELECT doc_id || ':' || sequence AS chunk_id, doc_id, sequence, chunk.section AS section, chunk.text AS text, CAST(ceil(length(chunk.text) / 4.0) AS BIGINT) AS token_estimate FROM told""")
def chunk_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = parallel(derive(spark, folder, HEADED)).select("doc_id", F.inline(chunking.document_chunks(F.col("text"), TARGET)))
    return rows.select(
        F.concat_ws(":", F.col("doc_id").cast("string"), F.col("sequence").cast("string")).alias("chunk_id"),
        "doc_id", "sequence", "section", "text", "token_estimate",
    )


ANSWERS = """
SELECT conv_id * 100 + turn AS answer_id, conv_id, turn, CASE turn % 5 WHEN 0 THEN '```json' || chr(10) || '{{"speaker":"' || role || '","chars":' || CAST(length(text) AS STRING) || '}}' || chr(10) || '```'
  WHEN 1 THEN '  {{"speaker":"' || role || '","chars":"many"}} ' WHEN 2 THEN '["' || role || '"]' WHEN 3 THEN 'Sure! {{"speaker":1}}' ELSE '```{{"speaker":null,"chars":1.5}}```' END AS answer
FROM {conversations}
"""


@query("""
WITH told AS (SELECT conv_id * 100 + turn AS answer_id, turn, role, length(text) AS n FROM conversations)
SELECT answer_id, turn % 5 IN (0, 1, 4) AS is_object, CASE WHEN turn % 5 IN (0, 1) THEN role END AS speaker, CASE WHEN turn % 5 = 0 THEN n END AS chars,
  CASE turn % 5 WHEN 0 THEN '{"speaker":"' || role || '","chars":' || n || '}' WHEN 1 THEN '{"speaker":"' || role || '","chars":"many"}' WHEN 2 THEN '["' || role || '"]'
    WHEN 3 THEN 'Sure! {"speaker":1}' ELSE '{"speaker":null,"chars":1.5}' END AS unfenced FROM told""")
def parsed_answers(spark: SparkSession, folder: str) -> DataFrame:
    answers = derive(spark, folder, ANSWERS)
    read = answers.withColumn("parsed", parsed_answer(F.col("answer")))
    return read.select(
        "answer_id",
        F.col("parsed").isNotNull().alias("is_object"),
        F.try_variant_get("parsed", "$.speaker", "string").alias("speaker"),
        token_usage(F.col("parsed"), "chars").alias("chars"),
        unfenced(F.col("answer")).alias("unfenced"),
    )


FACT_ANSWERS = """
SELECT conv_id * 100 + turn AS answer_id, '{{' || CASE turn % 4 WHEN 0 THEN '"company":"' || role || '",' WHEN 1 THEN '"company":null,' WHEN 2 THEN '"company":7,' ELSE '' END || '"other":1,'
  || CASE conv_id % 5 WHEN 0 THEN '"is_remote":true' WHEN 1 THEN '"is_remote":"no"' WHEN 2 THEN '"is_remote":null' WHEN 3 THEN '"is_remote":2' ELSE '"x":0' END || '}}' || CASE WHEN conv_id % 11 = 0 THEN ',' ELSE '' END AS answer
FROM {conversations}
"""


@query("""
SELECT conv_id * 100 + turn AS answer_id, ok AS valid, CASE WHEN ok AND turn % 4 = 0 THEN role END AS company, CASE WHEN ok THEN conv_id % 5 = 0 END AS is_remote
FROM (SELECT *, conv_id % 11 <> 0 AND turn % 4 <> 2 AND conv_id % 5 NOT IN (2, 3) AS ok FROM conversations)""")
def answer_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Typed facts of model answers; a wrong type makes the whole answer invalid."""
    read = stage(derive(spark, folder, FACT_ANSWERS), {"f": facts(F.col("answer"), "job")})
    return read.select("answer_id", F.col("f").isNotNull().alias("valid"), "f.company", "f.is_remote")


@query(f"WITH {CHUNK_SQL} SELECT doc_id, count(*) AS chunks, CAST(sum(ceil(length(chunk.text) / 4.0)) AS BIGINT) AS tokens FROM told GROUP BY doc_id")
def document_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks and estimated input tokens per document."""
    rows = parallel(derive(spark, folder, HEADED)).select("doc_id", chunking.document_chunks(F.col("text"), TARGET).alias("c"))
    total = F.aggregate("c", F.lit(0).cast("bigint"), lambda sum_, chunk: sum_ + chunk["token_estimate"])
    return rows.filter(F.size("c") > 0).select("doc_id", F.size("c").cast("bigint").alias("chunks"), total.alias("tokens"))


_SCHEMA = {"type": "object", "properties": {"company": {"type": "string"}}}
_SCHEMA_TEXT = (
    "{\n  \"properties\": {\n    \"company\": {\n      \"type\": \"string\"\n    }\n  },\n  \"type\": \"object\"\n}"
)


@query(f"""WITH {CHUNK_SQL}
SELECT doc_id, sequence, sha256('{INSTRUCTIONS}' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'Source context: ' || source || chr(10) || chr(10) ELSE '' END || 'JSON schema:' || chr(10) || '{_SCHEMA_TEXT}'
  || chr(10) || chr(10) || 'Source text:' || chr(10) || 'Title: ' || lang || chr(10) || 'Body: ' || chunk.text) AS prompt_hash FROM told JOIN documents USING (doc_id)""")
def prompts(spark: SparkSession, folder: str) -> DataFrame:
    """One prompt for each chunk of a document, so that all of its text is asked about."""
    headed = derive(spark, folder, HEADED_WITH_SOURCE)
    chunked = headed.select("doc_id", "lang", "source", F.inline(chunking.document_chunks(F.col("text"), TARGET)))
    text = labelled_text(Title=F.col("lang"), Body=F.col("text"))
    context = F.when(F.col("doc_id") % 2 == 0, F.col("source"))
    return chunked.select("doc_id", "sequence", F.sha2(prompt(text, _SCHEMA, context), 256).alias("prompt_hash"))


# One JSON part per turn with empty, scalar, nested, list and conflicting values.
PARTS = """
SELECT conv_id, turn, '{{"speaker":' || CASE WHEN turn % 3 = 0 THEN 'null' ELSE '"' || role || '"' END || ',"chars":' || CAST(length(text) AS STRING) || ',"note":' || CASE WHEN conv_id % 2 = 0 THEN '""' ELSE '[]' END
  || ',"tags":[' || CAST(turn AS STRING) || ',' || CAST(turn % 2 AS STRING) || ',"' || role || '"],"meta":' || CASE WHEN turn % 4 = 0 THEN '{{}}' ELSE '{{"last":' || CASE WHEN turn % 4 = 1 THEN 'null' ELSE CAST(turn AS STRING) END || ',"t' || CAST(turn % 3 AS STRING) || '":true}}' END
  || ',"mixed":' || CASE WHEN (conv_id + turn) % 2 = 0 THEN '5' ELSE '{{"a":1}}' END || '}}' AS payload
FROM {conversations}
"""


@query("""
WITH t AS (SELECT conv_id, turn, role, length(text) AS n FROM conversations),
tagged AS (SELECT conv_id, turn, unnest([turn::VARCHAR, (turn % 2)::VARCHAR, '"' || role || '"']) AS tag, unnest([0, 1, 2]) AS p, min(turn) OVER (PARTITION BY conv_id) AS first_turn FROM t),
firsts AS (SELECT conv_id, tag, turn, p FROM tagged QUALIFY turn = first_turn OR row_number() OVER (PARTITION BY conv_id, tag ORDER BY turn, p) = 1),
tags AS (SELECT conv_id, string_agg(tag, ', ' ORDER BY turn, p) AS tags FROM firsts GROUP BY conv_id),
base AS (SELECT conv_id, arg_min(role, turn) FILTER (turn % 3 <> 0) AS speaker, arg_min(n, turn) AS chars, min(turn) FILTER (turn % 4 > 1) AS last_turn,
  bool_or(turn % 4 <> 0 AND turn % 3 = 1) AS t1, arg_min((conv_id + turn) % 2 = 0, turn) AS scalar_first FROM t GROUP BY conv_id)
SELECT b.conv_id, b.speaker, b.chars, tags.tags AS tags, last_turn AS last, CASE WHEN t1 THEN true END AS t1, CASE WHEN scalar_first THEN '5' ELSE '{"a": 1}' END AS mixed,
  CASE WHEN b.conv_id % 2 = 0 THEN '' ELSE '[]' END AS note
FROM base b JOIN tags ON b.conv_id = tags.conv_id""")
def extraction_merge(spark: SparkSession, folder: str) -> DataFrame:
    merged = merge_extractions(derive(spark, folder, PARTS), "conv_id", "turn", "payload")
    get = lambda path: F.get_json_object("merged", path)
    return merged.select(
        "conv_id",
        get("$.speaker").alias("speaker"),
        get("$.chars").cast("bigint").alias("chars"),
        F.regexp_extract("merged", r'"tags": \[([^\]]*)\]', 1).alias("tags"),
        get("$.meta.last").cast("bigint").alias("last"),
        get("$.meta.t1").cast("boolean").alias("t1"),
        F.regexp_extract("merged", r'"mixed": (\{[^}]*\}|\d+)', 1).alias("mixed"),
        get("$.note").alias("note"),
    )


# Three providers share the calls; the event type tells how a call ended.
ATTEMPTS = """
SELECT event_id, 'provider' || CAST(user_id % 4 AS STRING) AS provider, CAST(user_id % 4 AS INT) AS position, event_type <> 'error' AS succeeded, user_id % 4 <> 3 AS used,
  CAST(CASE WHEN event_type = 'error' THEN CASE event_id % 5 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 400 WHEN 3 THEN 413 END END AS INT) AS status, event_id % 7 = 0 AS retryable, event_id % 35 = 4 AS timed_out
FROM {events}
"""


@query("""
WITH calls AS (SELECT user_id % 4 AS position, event_type <> 'error' AS ok FROM events),
rated AS (SELECT position, count(*) FILTER (ok AND position <> 3) AS successes, count(*) FILTER (NOT ok AND position <> 3) AS failures FROM calls GROUP BY position),
rates AS (SELECT *, successes + failures AS attempts, CASE WHEN successes + failures = 0 THEN 0.0 ELSE failures / (successes + failures) END AS failure_rate FROM rated)
SELECT 'provider' || position AS provider, successes, failures, attempts, failure_rate::DOUBLE AS failure_rate, row_number() OVER (ORDER BY failure_rate, position) AS rank FROM rates""")
def provider_order(spark: SparkSession, folder: str) -> DataFrame:
    attempts = derive(spark, folder, ATTEMPTS)
    providers = attempts.select("provider", "position").distinct()
    return fallback_order(providers, provider_health(attempts.filter("used"))).drop("position")


CHAINS = """
SELECT l_orderkey, l_linenumber AS rank, 'provider' || CAST(l_linenumber AS STRING) AS provider, l_quantity > 25 AS succeeded,
  CAST(CASE l_partkey % 4 WHEN 0 THEN 400 WHEN 1 THEN 503 WHEN 2 THEN 429 END AS INT) AS status, l_partkey % 8 = 3 AS retryable, l_partkey % 8 = 7 AS timed_out
FROM {lineitem}
"""


@query("""
WITH calls AS (SELECT l_orderkey, l_linenumber AS rank, l_quantity > 25 AS ok, l_partkey % 4 IN (1, 2) OR l_partkey % 8 IN (3, 7) AS goes_on FROM lineitem),
firsts AS (SELECT l_orderkey, min(rank) FILTER (ok) AS won, min(rank) FILTER (NOT ok AND NOT goes_on) AS stopped FROM calls GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN won IS NOT NULL AND (stopped IS NULL OR won < stopped) THEN 'succeeded' WHEN stopped IS NOT NULL THEN 'failed' ELSE 'exhausted' END AS outcome,
  CASE WHEN won IS NOT NULL AND (stopped IS NULL OR won < stopped) THEN 'provider' || won END AS provider FROM firsts""")
def fallback_chain(spark: SparkSession, folder: str) -> DataFrame:
    calls = derive(spark, folder, CHAINS)
    calls = calls.withColumn("falls_back", falls_back(F.col("status"), F.col("retryable"), F.col("timed_out")))
    return fallback_result(calls, "l_orderkey")


@query("""
SELECT event_id, coalesce(status = 429 OR status BETWEEN 500 AND 599, false) AS transient, coalesce(status IN (413, 429) OR status >= 500, false) OR event_id % 7 = 0 OR event_id % 35 = 4 AS falls_back,
  least(8.0, 0.5 * pow(2, user_id % 9))::DOUBLE AS delay, greatest(least(8.0, 0.5 * pow(2, user_id % 9)), CASE WHEN event_id % 3 = 0 THEN value ELSE 0 END)::DOUBLE AS waited
FROM (SELECT *, CASE WHEN event_type = 'error' THEN CASE event_id % 5 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 400 WHEN 3 THEN 413 END END AS status FROM events)""")
def retry_rules(spark: SparkSession, folder: str) -> DataFrame:
    calls = derive(spark, folder, ATTEMPTS).join(
        table(spark, folder, "events").select("event_id", "user_id", "value"), "event_id"
    )
    attempt = F.col("user_id") % 9 + 1
    header = F.when(F.col("event_id") % 3 == 0, F.col("value"))
    return calls.select(
        "event_id",
        F.coalesce(is_transient_status(F.col("status")), F.lit(False)).alias("transient"),
        falls_back(F.col("status"), F.col("retryable"), F.col("timed_out")).alias("falls_back"),
        backoff_seconds(attempt, base=0.5, cap=8.0).alias("delay"),
        backoff_seconds(attempt, base=0.5, cap=8.0, retry_after=header).alias("waited"),
    )


DELIVERIES = """
SELECT event_id, CASE user_id % 5 WHEN 0 THEN 'FETCH_URL' WHEN 1 THEN 'PARSE_DOCUMENT' WHEN 2 THEN 'EXPORT_RECORD' WHEN 3 THEN 'RESOLVE_ENTITY' ELSE 'CLEAN_UP' END AS job_type,
  CASE WHEN event_type = 'error' THEN 'TimeoutError' WHEN event_type = 'signup' THEN 'ValueError' END AS error_type, CAST(event_id % 5 AS INT) AS attempts
FROM {events}
"""

_OUTCOME_SQL = f"""
raw AS ({plain(DELIVERIES)}),
told AS (SELECT *, CASE WHEN job_type = 'CLEAN_UP' THEN 'dead_lettered' WHEN error_type IS NULL THEN 'processed' WHEN attempts >= 3 THEN 'dead_lettered' ELSE 'retried' END AS outcome FROM raw)
"""


@query(f"""WITH {_OUTCOME_SQL}
SELECT event_id, outcome, CASE WHEN job_type = 'CLEAN_UP' THEN 'unknown_job_type' WHEN outcome = 'dead_lettered' THEN 'max_retries:' || error_type END AS reason,
  CASE WHEN outcome = 'retried' THEN least(8.0, 0.5 * pow(2, attempts))::DOUBLE END AS delay_seconds FROM told""")
def worker_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    jobs = derive(spark, folder, DELIVERIES)
    outcome = worker_outcome(F.col("job_type"), F.col("error_type"), F.col("attempts"))
    return jobs.select("event_id", outcome.alias("o")).select("event_id", "o.*")


@query(f"""WITH {_OUTCOME_SQL}
SELECT job_type, count(*) FILTER (outcome = 'processed') AS processed, count(*) FILTER (outcome = 'retried') AS retried, count(*) FILTER (outcome = 'dead_lettered') AS dead_lettered
FROM told GROUP BY job_type""")
def worker_totals(spark: SparkSession, folder: str) -> DataFrame:
    jobs = derive(spark, folder, DELIVERIES)
    outcome = worker_outcome(F.col("job_type"), F.col("error_type"), F.col("attempts"))
    counted = jobs.select("job_type", outcome["outcome"].alias("outcome"))
    return counted.groupBy("job_type").agg(
        *[F.count_if(F.col("outcome") == name).alias(name) for name in ("processed", "retried", "dead_lettered")]
    )


FOLDS = """
SELECT p_partkey, 'https://p.example.org/' || CAST(p_partkey AS STRING) AS canonical_url, p_name AS title, CASE WHEN p_partkey % 3 = 0 THEN 'Unknown' ELSE p_brand END AS startup_name, 'FREE' AS pricing_model,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS BIGINT) END AS employee_count, CASE WHEN p_partkey % 4 = 0 THEN 'Town' END AS headquarters, CAST(NULL AS BIGINT) AS founded_year
FROM {part}
"""
FOUND = """
SELECT 'https://p.example.org/' || CAST(p_partkey AS STRING) AS canonical_url, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS startup_name, CASE p_partkey % 3 WHEN 0 THEN 'PAID' WHEN 1 THEN 'CHEAP' END AS pricing_model,
  CAST(7 AS BIGINT) AS employee_count, 'City' AS headquarters, CAST(CASE WHEN p_partkey % 5 = 0 THEN 1999 END AS BIGINT) AS founded_year
FROM {part} WHERE p_partkey % 7 <> 0
"""


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 2 = 0 THEN p_type ELSE 'Unknown' END ELSE p_brand END AS startup_name,
  CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 3 = 0 THEN 'PAID' ELSE 'FREE' END AS pricing_model, p_partkey % 7 <> 0 AS model_used FROM part""")
def product_fold(spark: SparkSession, folder: str) -> DataFrame:
    folded = enrichment.fold_product(derive(spark, folder, FOLDS), derive(spark, folder, FOUND), "canonical_url", "p_partkey")
    return folded.select("p_partkey", "startup_name", "pricing_model", "model_used")


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size WHEN p_partkey % 7 <> 0 THEN 7 END AS employee_count, CASE WHEN p_partkey % 4 = 0 THEN 'Town' WHEN p_partkey % 7 <> 0 THEN 'City' END AS headquarters,
  CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 5 = 0 THEN 1999 END AS founded_year, p_partkey % 7 <> 0 AS model_used FROM part""")
def startup_fold(spark: SparkSession, folder: str) -> DataFrame:
    folded = enrichment.fold_startup(derive(spark, folder, FOLDS), derive(spark, folder, FOUND), "canonical_url", "p_partkey")
    return folded.select("p_partkey", "employee_count", "headquarters", "founded_year", "model_used")


POSTS = """
SELECT o_orderkey, 'https://j.example.org/' || CAST(o_orderkey AS STRING) AS canonical_url, 'Clerk' AS company, o_orderkey % 2 = 0 AS is_remote, CASE WHEN o_orderkey % 3 = 0 THEN 'Sales' END AS role_family, 'AI' AS category FROM {orders}
"""
POST_FACTS = """
SELECT 'https://j.example.org/' || CAST(o_orderkey AS STRING) AS canonical_url, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN o_orderpriority END AS company, o_orderkey % 7 = 0 AS is_remote,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Design' END AS role_family, CASE WHEN o_orderkey % 4 = 1 THEN 'Policy' ELSE '' END AS category FROM {orders} WHERE o_orderstatus <> 'P'
"""


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 5 = 1 THEN o_orderpriority ELSE 'Clerk' END AS company, o_orderkey % 2 = 0 OR (o_orderstatus <> 'P' AND o_orderkey % 7 = 0) AS is_remote,
  CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 4 = 0 THEN 'Design' WHEN o_orderkey % 3 = 0 THEN 'Sales' END AS role_family,
  CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 4 = 1 THEN 'Policy' ELSE 'AI' END AS category FROM orders""")
def post_folds(spark: SparkSession, folder: str) -> DataFrame:
    posts, facts = derive(spark, folder, POSTS), derive(spark, folder, POST_FACTS)
    jobs = enrichment.fold_job(posts, facts, "canonical_url", "o_orderkey")
    news = enrichment.fold_news(jobs, facts, "canonical_url", "o_orderkey")
    return news.select("o_orderkey", "company", "is_remote", "role_family", "category")
