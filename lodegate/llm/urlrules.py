"""URL filters by rules that are indexed under their rarest literal token.

A rule is either a host rule, ``host/path``, or a pattern. A host rule fits its host and all
subdomains where the path starts with the rule's. In a pattern ``*`` stands for any characters,
``^`` for one separator (an ASCII character that is no letter or digit) or an end of the address,
``||`` for the start of a label of the host, ``|`` for an end of the address.

A token is a run of characters between separators. Only tokens that a rule's text bounds on both
sides are sure to be tokens of every address it fits; of these each rule is indexed under the one
that the fewest addresses of the table hold. An address fetches the rules of its own tokens and
runs the regular expressions of those alone. Rules without a bounded token are tried on every
address. Rules come in blocks of at most ``BLOCK``; each block is one narrow step over the
addresses, so nothing is shuffled but token counts, and hot hosts need no care.

Host rules go before patterns, then the longer rule wins, then block before allow, then the greater
text. Where no rule fits, the verdict is allow.

Defined cases: an address that is null or has no ``://`` has an empty host and path and no fitting
rule; every row is judged on its own, so repeated and null ids stay; an empty table gives an empty
table; columns other than page_id and url are not looked at; a rule with a host of no characters,
or a path with ``?`` or ``#``, raises ValueError.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodegate.llm.context import prepare

BLOCK = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = str.maketrans(_UPPER, _LOWER)
_SEPARATORS = r"\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f"
_TOKEN = re.compile(f"[^{_SEPARATORS}]+")
# Parts of a rule beside its literals, each with its regular expression. None of them is part of a token.
_ANY, _SEPARATOR, _LABEL, _START, _END, _HOST_END = (
    r"[\s\S]*", f"(?:^|[{_SEPARATORS}]|$)", r"^(?:[^/?]*\.)?", "^", r"\Z", r"(?=[/?]|\Z)",
)


@dataclass(frozen=True)
class Rule:
    action: str
    text: str
    is_host_rule: bool
    expression: str
    tokens: tuple[str, ...]  # those sure to be tokens of every address that the rule fits

    def rank(self) -> tuple[bool, int, bool, str]:
        return self.is_host_rule, len(self.text), self.action == "block", self.text


def _rule(action: str, text: str, is_host_rule: bool, parts: list[tuple[bool, str]]) -> Rule:
    """``parts`` are literals (True, text) and the others (False, expression), in order."""
    if action not in ("allow", "block"):
        raise ValueError(f"A rule allows or blocks; it can't {action!r}")
    tokens = []
    for at, (literal, value) in enumerate(parts):
        if literal:
            bounded_left = at > 0 and parts[at - 1][1] != _ANY
            bounded_right = at + 1 < len(parts) and parts[at + 1][1] != _ANY
            for found in _TOKEN.finditer(value):
                if (found.start() or bounded_left) and (found.end() < len(value) or bounded_right):
                    tokens.append(found[0].translate(_ASCII_LOWER))
    expression = "".join(re.escape(value) if literal else value for literal, value in parts)
    return Rule(action, text, is_host_rule, expression, tuple(dict.fromkeys(tokens)))


def host_rule(action: str, text: str) -> Rule:
    host, slash, rest = text.partition("/")
    if not host or "?" in text or "#" in text:
        raise ValueError(f"Not a host and a path: {text!r}")
    literal = (True, host.translate(_ASCII_LOWER) + slash + rest)
    return _rule(action, text, True, [(False, _LABEL), literal] + ([] if slash else [(False, _HOST_END)]))


def pattern_rule(action: str, text: str) -> Rule:
    """Patterns don't tell A-Z from a-z."""
    body, parts = text.translate(_ASCII_LOWER), []
    if body.startswith("||"):
        body, parts = body[2:], [(False, _LABEL)]
    elif body.startswith("|"):
        body, parts = body[1:], [(False, _START)]
    ends = body.endswith("|")
    for piece in re.split(r"([*^])", body[:-1] if ends else body):
        if piece:
            parts.append((False, {"*": _ANY, "^": _SEPARATOR}[piece]) if piece in "*^" else (True, piece))
    return _rule(action, text, False, parts + [(False, _END)] * ends)


def split_address(url: str | None) -> tuple[str, str, str]:
    """Host, path, and what follows the path up to the fragment."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", ""
    rest = rest.partition("#")[0]
    host = re.match(r"[^/?]*", rest)[0]
    path = re.match(r"[^?]*", rest[len(host) :])[0]
    return host.translate(_ASCII_LOWER), path, rest[len(host) + len(path) :]


def address_tokens(address: str) -> set[str]:
    return set(_TOKEN.findall(address.translate(_ASCII_LOWER)))


_JUDGED = (
    "page_id long, host string, path string, address string, rule_text string, rule_action string, "
    "is_host_rule boolean, n_candidates long"
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        split = [split_address(url) for url in batch.column(1).to_pylist()]
        n = len(split)
        columns = [batch.column(0), *(pa.array(x, pa.string()) for x in zip(*split))] if n else []
        if n:
            columns[3] = pa.array(["".join(parts) for parts in split], pa.string())
            columns += [pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.bool_()), pa.array([0] * n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "host", "path", "address", "rule_text", "rule_action", "is_host_rule", "n_candidates"])


def index_rules(rules: Iterable[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; those without one are under the empty token."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda token: (counts.get(token, 0), token), default="")
        index.setdefault(rarest, []).append(rule)
    return index


def _judge_by(index: dict[str, list[Rule]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def best(address: str, compiled: Callable[[str], re.Pattern]) -> tuple[Rule | None, int]:
        found, tried = None, 0
        lowered = address.translate(_ASCII_LOWER)
        for token in (*address_tokens(address), ""):
            for rule in index.get(token, ()):
                tried += 1
                if (found is None or rule.rank() > found.rank()) and compiled(rule.expression).search(address if rule.is_host_rule else lowered):
                    found = rule
        return found, tried

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = cache(re.compile)
        for batch in batches:
            texts, actions, hosts, tries = (batch.column(k).to_pylist() for k in (4, 5, 6, 7))
            for at, address in enumerate(batch.column(3).to_pylist()):
                if not address:
                    continue
                found, tried = best(address, compiled)
                tries[at] += tried
                earlier = texts[at] is not None and (hosts[at], len(texts[at]), actions[at] == "block", texts[at])
                if found is not None and (not earlier or found.rank() > earlier):
                    texts[at], actions[at], hosts[at] = found.text, found.action, found.is_host_rule
            columns = [*batch.columns[:4], pa.array(texts, pa.string()), pa.array(actions, pa.string()), pa.array(hosts, pa.bool_()), pa.array(tries, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def token_counts(addresses: DataFrame, wanted: set[str]) -> dict[str, int]:
    """How many addresses hold each of the ``wanted`` tokens, which are those of a block of rules."""
    spark = addresses.sparkSession
    lowered = F.translate("address", _UPPER, _LOWER)
    held = F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"([^{_SEPARATORS}]+)"), F.lit(1)))
    asked = spark.createDataFrame([(token,) for token in sorted(wanted)], "token string")
    counts = addresses.select(F.explode(held).alias("token")).join(F.broadcast(asked), "token").groupBy("token").count()
    return {row["token"]: row["count"] for row in counts.collect()}


def judge_addresses(pages: DataFrame, rules: Iterable[Rule], block: int = BLOCK) -> DataFrame:
    """page_id, host, path, the host rule that decides (else null), the verdict, the pattern that
    decides (else null) and how many regular expressions were run (n_candidates)."""
    prepare(pages.sparkSession)
    addresses = pages.select(F.col("`page_id`").cast("long").alias("page_id"), F.col("`url`").cast("string").alias("url")).mapInArrow(_parse, _JUDGED)
    judged = addresses
    for part in batched(rules, block):
        wanted = {token for rule in part for token in rule.tokens if len(rule.tokens) > 1}
        judged = judged.mapInArrow(_judge_by(index_rules(part, token_counts(addresses, wanted) if wanted else {})), _JUDGED)
    return judged.select(
        "page_id", "host", "path",
        F.when(F.col("is_host_rule"), F.col("rule_text")).alias("rule"),
        F.coalesce("rule_action", F.lit("allow")).alias("verdict"),
        F.when(~F.col("is_host_rule"), F.col("rule_text")).alias("pattern"),
        "n_candidates",
    )


# The host rules of the contract, and words that addresses of unwanted sites hold as whole tokens.
HOST_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)
UNWANTED = (
    "adult", "ads", "bet", "bets", "betting", "casino", "gambling", "jackpot", "payday", "pills", "poker", "porn", "sex",
    "slots", "spam", "track", "tracker", "viagra", "warez", "xxx",
)


def default_rules() -> list[Rule]:
    return [host_rule(action, text) for action, text in HOST_RULES] + [pattern_rule("block", f"^{word}^") for word in UNWANTED]
