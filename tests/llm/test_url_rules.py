"""URL rules against every rule tried on every address."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings, strategies as st

from lodegate.llm.urlrules import _ASCII_LOWER, address_tokens, default_rules, host_rule, index_rules, judge_addresses, pattern_rule, split_address
from tests.llm.conftest import FOLDER
from tests.llm.harness import differences

ODD_URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "HTTPS://WWW.Example.COM/en/x", "http://example.com/en/", "http://example.com/EN/",
    "http://a.example.com/en/1?x=://net/es/", "http://notexample.com/en/", "http://a.net/es/", "http://net/fr/#x", "http://a.net?/fr/", "http://a.net:80/fr/",
    "http://x.org/casino", "http://x.org/supercasino/", "http://x.org/a?b=Casino", "http://x.org/#casino", "http://é.net/es/é", "://b.net/fr/", "http://a\n.net/es/\n",
    "http://casino.com/", "http://u@a.net/es/", "http://x.net/es", "http://casinoé.org/", "http://a.com./", "x" * 50_000 + "://a.net/fr/" + "y" * 50_000,
]


def _fits(rule, url: str | None) -> bool:
    """A rule by its words, without the index and without its expression."""
    host, path, query = split_address(url)
    if rule.is_host_rule:
        name, slash, rest = rule.text.partition("/")
        return ("." + host).endswith("." + name.lower()) and path.startswith(slash + rest)
    return bool(re.search(rule.expression, (host + path + query).translate(_ASCII_LOWER))) and bool(host + path + query)


def _expected(rules, url):
    fitting = [rule for rule in rules if _fits(rule, url)]
    best = max(fitting, key=lambda rule: (rule.is_host_rule, len(rule.text), rule.action == "block", rule.text), default=None)
    host, path, _ = split_address(url)
    of = lambda kind: best.text if best and best.is_host_rule == kind else None
    return host, path, of(True), best.action if best else "allow", of(False)


MORE = default_rules() + [
    host_rule("block", "x.org"), host_rule("allow", "org/a"), pattern_rule("block", "||x.org^*b=|"), pattern_rule("allow", "|x.org^casino"),
    pattern_rule("block", "sino/"), pattern_rule("allow", "*"), pattern_rule("block", "net/es|"),
]


def test_odd_addresses_by_every_rule(spark):
    rows = [(k % 5 or None, url, "x", "y", 1) for k, url in enumerate(ODD_URLS)] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, rule string, host string, n_candidates int").repartition(3)
    for rules in (default_rules(), MORE, []):
        for block in (3, 1000):
            found = judge_addresses(frame, rules, block).collect()
            names = ("host", "path", "rule", "verdict", "pattern")
            assert sorted(map(str, ((r["page_id"], *(r[n] for n in names)) for r in found))) == sorted(map(str, ((key, *_expected(rules, url)) for key, url, *_ in rows)))
    assert judge_addresses(frame.filter("false"), MORE).count() == 0


def test_contract_cases():
    rules = default_rules()
    for url, rule, verdict in [
        ("http://a.com/x", "com/", "allow"), ("http://a.example.com/en/1", "example.com/en/", "block"), ("http://www.example.com/en/1", "www.example.com/en/", "allow"),
        ("http://a.www.example.com/en/", "www.example.com/en/", "allow"), ("http://a.com", None, "allow"), ("http://casino.com/", "com/", "allow"),
        ("http://b.net/es/1", "net/es/", "block"), ("http://spam-farm.example.org/en/1", None, "block"), ("http://spam-farm.example.net/en/1", None, "block"),
    ]:
        assert _expected(rules, url)[2:4] == (rule, verdict), url


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab.-/^*|?", min_size=1, max_size=8), st.text(alphabet="abAB.-/?", max_size=14))
def test_a_fitting_rule_is_always_fetched(pattern, rest):
    rule = pattern_rule("block", pattern)
    address = "".join(split_address("x://" + rest))
    if re.search(rule.expression, address.translate(_ASCII_LOWER)):
        assert set(rule.tokens) <= address_tokens(address)


def test_rules_stand_under_their_rarest_token():
    rules = [host_rule("block", "example.com/en/"), pattern_rule("block", "ads*"), pattern_rule("block", "^ads^")]
    index = index_rules(rules, {"example": 50, "com": 9, "en": 20, "ads": 3})
    assert {token: [r.text for r in found] for token, found in index.items()} == {"com": ["example.com/en/"], "": ["ads*"], "ads": ["^ads^"]}


def test_few_expressions_run(spark):
    rules = default_rules() + [host_rule("block", f"site{k}.example.org/") for k in range(5000)]
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    # Five host rules share tokens with many addresses; of 5020 others hardly one does.
    assert judge_addresses(pages, rules).agg({"n_candidates": "max"}).first()[0] <= 8


@pytest.mark.parametrize("text", ["", "/x", "a.com/x?y", "a.com/#"])
def test_unusable_host_rules(text):
    with pytest.raises(ValueError):
        host_rule("block", text)


def test_url_query_equals_its_sql(spark):
    assert differences(spark, FOLDER, "op11_rarest_token_rules") == ""
