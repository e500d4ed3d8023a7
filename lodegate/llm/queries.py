"""Queries of these operators over whole tables, for the driver."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.llm.bagminhash import near_classes
from lodegate.llm.chat import digests, read_back, windows
from lodegate.llm.context import prepare, table
from lodegate.llm.leaks import find_leaks
from lodegate.llm.mainhtml import extract
from lodegate.llm.manifest import proofs, tampered
from lodegate.llm.packing import pack
from lodegate.llm.pseudonyms import pseudonymise, session_key
from lodegate.llm.quality import judge
from lodegate.llm.suffixes import without_repeats
from lodegate.llm.toxicity import score
from lodegate.llm.urlrules import HOST_RULES, UNWANTED, default_rules, judge_addresses
from lodegate.llm.warc import capture_records, captures, read_records, resolved, write_archives
from lodegate.llm.whitening import whiten
from lodegate.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def prepared(spark: SparkSession, folder: str) -> DataFrame:
        return run(prepare(spark), folder)

    QUERIES[run.__name__] = prepared
    return run


# Its texts hold the markers and the escape of templates.
_MARKERS = r"\### Assistant: </turn> ok"


@query
def op1_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", _MARKERS), (-7, 1, "assistant", _MARKERS)], given.schema)
    return digests(read_back(windows(given.unionByName(own))))


@query
def op2_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and the id of its near-duplicate class, the smallest doc_id in it."""
    return near_classes(table(spark, folder, "documents"))


@query
def op3_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    done = pseudonymise(table(spark, folder, "documents"), key=session_key(spark))
    return done.select("doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"))


@query
def op4_two_stage_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """The digest columns, what was removed, and what is left as text (a code point cut in two shows as U+FFFD)."""
    cut = without_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["stop"] - span["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


@query
def op5_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("p_good", 9).alias("p_good"),
    )


@query
def op6_warc_transactions(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write_archives(capture_records(table(spark, folder, "pages")), path)
    return resolved(captures(read_records(spark, path)))


ORACLES["op6_warc_transactions"] = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query
def op7_seed_and_align(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_shortest_pack_first(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


@query
def op9_convolutional_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_line_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


@query
def op11_rarest_token_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Host rules decide where one fits, else patterns of unwanted words as whole tokens."""
    return judge_addresses(table(spark, folder, "pages"), default_rules()).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op11_rarest_token_rules"] = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS given_host, regexp_extract(rest, '^[^#]*') AS whole FROM cut
), part AS (
    SELECT page_id, translate(given_host, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
           regexp_extract(substr(whole, length(given_host) + 1), '^[^?]*') AS path,
           translate(whole, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS address
    FROM split
), rules (action, rule) AS (VALUES {', '.join(f"('{action}', '{rule}')" for action, rule in HOST_RULES)}
), fitting AS (
    SELECT host AS h, path AS p, max_by(rule, length(rule)) AS rule, max_by(action, length(rule)) AS action
    FROM (SELECT DISTINCT host, path FROM part) AS part, rules
    WHERE ends_with('.' || host, '.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, strpos(rule, '/')))
    GROUP BY ALL
)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN regexp_matches(address, '(^|[^a-z0-9\\x80-\\x{{10FFFF}}])({'|'.join(UNWANTED)})([^a-z0-9\\x80-\\x{{10FFFF}}]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM part LEFT JOIN fitting ON h = host AND p = path
"""


@query
def op12_contour_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


@query
def op13_octopus_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return proofs(table(spark, folder, "documents"), tampered)


# CRC-32 by bits, over the digits of an id.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)), lambda crc, byte:
    list_reduce(list_prepend(xor(crc, byte), range(8)), lambda r, k: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)))"""
_LEAF = " || ".join(
    f"coalesce(octet_length(encode(CAST({name} AS VARCHAR))) || ':' || {name}, '-')" for name in ("doc_id", "source", "lang", "n_chars", "{0}")
)
_BESIDE = """string_agg(digest, '') OVER (PARTITION BY {0}level, place // 8 ORDER BY place ROWS BETWEEN {1})"""


def _tree_sql(name: str, tree: str, leaves: str) -> str:
    """Nodes of all levels above ``leaves`` (tree, place, n, digest), each with its siblings before and after."""
    same, grouped = (f"{tree}, ", f"{tree}, ") if tree else ("", "")
    return f"""{name}_nodes AS (
    SELECT {same}0 AS level, place, n, digest FROM {leaves}
    UNION ALL
    SELECT {same}level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place)) FROM {name}_nodes WHERE n > 1 GROUP BY {grouped}level, place // 8, n
), {name} AS (
    SELECT *, coalesce({_BESIDE.format(same, "UNBOUNDED PRECEDING AND 1 PRECEDING")}, '') AS before,
           coalesce({_BESIDE.format(same, "1 FOLLOWING AND UNBOUNDED FOLLOWING")}, '') AS after FROM {name}_nodes
)"""


ORACLES["op13_octopus_manifest"] = f"""
WITH RECURSIVE given AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, sha256({_LEAF.format('text')}) AS digest,
           sha256({_LEAF.format("CASE WHEN hit THEN translate(text, '" + string.ascii_uppercase + "', '" + string.ascii_lowercase + "') ELSE text END")}) AS offered
    FROM (SELECT *, coalesce({_CRC32.format("CAST(doc_id AS VARCHAR)")} % 3 = 0, false) AS hit FROM documents)
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest, r) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM given
), {_tree_sql('low', 'tree', 'leaves')}, subroots AS (
    SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1
), {_tree_sql('high', '', 'subroots')}, ways AS (
    SELECT r, tree, 0 AS level, place, n, digest AS mine, offered AS shown, '' AS proof FROM leaves
    UNION ALL
    SELECT r, tree, w.level + 1, w.place // 8, (w.n + 7) // 8, sha256(before || mine || after), sha256(before || shown || after), proof || before || after
    FROM ways AS w JOIN low USING (tree, level, place) WHERE w.n > 1
), met AS (
    SELECT ways.r, ways.tree, mine AS subroot, shown, proof, subroots.place, subroots.n FROM ways JOIN subroots USING (tree) WHERE ways.n = 1
), over AS (
    SELECT r, 0 AS level, place, n, subroot AS mine, shown, proof FROM met
    UNION ALL
    SELECT r, o.level + 1, o.place // 8, (o.n + 7) // 8, sha256(before || mine || after), sha256(before || shown || after), proof || before || after
    FROM over AS o JOIN high USING (level, place) WHERE o.n > 1
)
SELECT doc_id, digest AS leaf, met.subroot, over.mine AS root, sha256(over.proof) AS proof_sha256, over.shown AS folded_root, over.shown = over.mine AS verified
FROM leaves JOIN met USING (r) JOIN over USING (r) WHERE over.n = 1
"""
