"""Known input and output pairs of the column functions."""

import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lodegate.functions import chunking, dates, directory, identity, markup, text
from lodegate.operators.extraction import facts
from lodegate.operators.freshness import freshness_decision

NOW = "2026-09-11 12:00:00+00:00"


def one(spark, column, value=None):
    frame = spark.createDataFrame([(value,)], "v string")
    return frame.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        (
            "http://EXAMPLE.com:80/paper/?id=42&utm_source=newsletter&b=2&a=1#heading",
            "https://example.com/paper?a=1&b=2&id=42",
        ),
        ("https://a.com", "https://a.com/"),
        ("http://a.com//", "https://a.com"),
        ("http://u:p@A.com:8080/x%2Fy/%7e?q=a+b&GCLID=1&k", "https://a.com:8080/x/y/~?k=&q=a+b"),
        ("http://a.com/%zz%C3%BC ü", "https://a.com/%zz%C3%BC%20%C3%BC"),
        ("ftp://a.com/", None),
        ("http:///x", None),
        ("http://a.com:99999/", None),
        ("not a url", None),
    ],
)
def test_canonical_url(spark, url, expected):
    assert one(spark, identity.canonical_url(F.col("v")), url) == expected


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("HTTPS://WWW.GITHUB.COM/Example/Repository.git/?utm_source=feed#readme", "https://github.com/example/repository"),
        ("https://github.com/only-owner", None),
        ("https://github.com/a/b/issues", None),
        ("https://user@github.com/a/b", None),
        ("https://example.com/a/b", None),
    ],
)
def test_repository_url(spark, url, expected):
    assert one(spark, identity.repository_url(F.col("v")), url) == expected


def test_hashes(spark):
    digest = one(spark, identity.content_hash(F.col("v")), "source evidence")
    assert digest == hashlib.sha256(b"source evidence").hexdigest() and digest.startswith("9c7c9338")
    joined = hashlib.sha256("s\x1fhttps://a.com/".encode()).hexdigest()
    assert one(spark, identity.record_id(F.lit("s"), F.col("v")), "https://a.com/") == joined


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("OpenAI, Inc.", "openai"),
        ("Open AI", "openai"),
        ("Mistrál-AI LLC", "mistralai"),
        ("Weights & Biases Co. Ltd", "weightsandbiases"),
        ("Straße GmbH", "strasse"),
        ("Inc", ""),
        ("ﬁrm № 5", "firmno5"),
    ],
)
def test_entity_key(spark, name, expected):
    assert one(spark, text.entity_key(F.col("v")), name) == expected


@pytest.mark.parametrize("value", ["Straße ẞ ﬁ ﬃ ΑΣ ς ſ µ İ ŉ Ꭰꭰ ǰ", "PLAIN ascii", "ÀÉ", ""])
def test_casefold_equals_python(spark, value):
    assert one(spark, text.casefold(F.col("v")), value) == value.casefold()


@pytest.mark.parametrize("value", [" a  b ", "a  b\n", "　", "x", "a\x1fb", "tab\tend\r\n"])
def test_collapse_equals_python(spark, value):
    assert one(spark, text.collapse(F.col("v")), value) == " ".join(value.split())


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("2026-09-11T11:00:00Z", "2026-09-11T11:00:00.000000Z"),
        ("20260911", "2026-09-11T00:00:00.000000Z"),
        ("2026-W37-5", "2026-09-11T00:00:00.000000Z"),
        ("2021-W53-1", None),
        ("Fri, 11 Sep 2026 11:00:00 GMT", "2026-09-11T11:00:00.000000Z"),
        ("11 Sep 2026 11:00 EST", "2026-09-11T16:00:00.000000Z"),
        ("2 hours ago", "2026-09-11T10:00:00.000000Z"),
        ("Yesterday", "2026-09-10T12:00:00.000000Z"),
        ("Sep 11", "2026-09-11T00:00:00.000000Z"),
        ("Posted 2 hours ago", None),
        ("2026-02-30", None),
        ("", None),
    ],
)
def test_evidence_timestamp(spark, raw, expected):
    now = F.lit(NOW).cast("timestamp")
    assert one(spark, dates.utc_text(dates.evidence_timestamp(F.col("v"), now)), raw) == expected


@pytest.mark.parametrize(
    ("hours", "confidence", "expected"),
    [
        (0.0, 0.75, ("ACCEPT", "fresh")),
        (24.0, 0.9, ("ACCEPT", "fresh")),
        (25.0, 0.9, ("REJECT", "stale_date")),
        (-1 / 60, 0.9, ("REJECT", "future_date")),
        (2.0, 0.6, ("QUARANTINE", "low_confidence_date")),
        (None, 0.9, ("QUARANTINE", "date_unresolved")),
    ],
)
def test_gate_limits(spark, hours, confidence, expected):
    now = F.lit(NOW).cast("timestamp")
    at = F.lit(None).cast("timestamp") if hours is None else F.timestamp_micros(F.unix_micros(now) - F.lit(int(hours * 3.6e9)))
    decision = one(spark, freshness_decision(at, F.lit("rss"), F.lit(confidence), now))
    assert (decision["status"], decision["reason"]) == expected


def test_article_with_linked_data(spark):
    sentence = "The launch was announced on Friday with a long list of details about the system. "
    html = (
        '<html><head><title> Big   Launch </title><script type="application/ld+json">{"datePublished": "2026-08-15T14:30:00Z",'
        '"author": {"name": "A. Writer"}}</script></head><body><nav>Home</nav><article><h1>Big Launch</h1><p>'
        + sentence * 3 + "</p></article><footer>Copyright</footer></body></html>"
    )
    frame = spark.createDataFrame([(html,)], "v string").select(markup.article_pieces("v").alias("p"))
    row = frame.select(
        F.col("p.title").alias("title"),
        markup.article_body(F.col("p"), F.lit("")).alias("body"),
        markup.article_author(F.col("p")).alias("author"),
        markup.article_date(F.col("p"), F.lit(""), F.lit(NOW).cast("timestamp")).alias("date"),
    ).first()
    assert row["title"] == "Big Launch"
    assert row["body"].startswith("Big Launch" + "The launch") and "Copyright" not in row["body"]
    assert row["author"] == "A. Writer"
    assert (row["date"]["source"], row["date"]["confidence"]) == ("json_ld", 0.95)
    assert row["date"]["published_at"].astimezone(timezone.utc) == datetime(2026, 8, 15, 14, 30, tzinfo=timezone.utc)


def test_short_page_yields_to_fallback(spark):
    frame = spark.createDataFrame([("<html><body>Empty</body></html>",)], "v string")
    body = markup.article_body(F.col("p"), F.lit("Fallback article body text"))
    assert frame.select(markup.article_pieces("v").alias("p")).select(body).first()[0] == "Fallback article body text"


@pytest.mark.parametrize(
    ("node", "expected"),
    [
        ('{"pricingModel":"free"}', "FREE"),
        ('{"isAccessibleForFree":true,"offers":{"price":5}}', "FREE"),
        ('{"offers":{"price":0}}', "FREE"),
        ('{"offers":[{"price":"7"},{"price":" 0.0 "}]}', "FREE"),
        ('{"offers":[{"description":"enterprise tier","price":0}]}', "ENTERPRISE"),
        ('{"offers":{"price":9.5}}', "PAID"),
        ('{"offers":{"price":"9"}}', None),
        ("{}", None),
    ],
)
def test_linked_data_pricing(spark, node, expected):
    assert one(spark, directory.linked_data_pricing(F.parse_json(F.col("v"))), node) == expected


def test_json_must_end(spark):
    from lodegate.functions.binding import json_value

    for broken in ('{"a":1}]', '{"a":1}}', '{"a":1},{"b":2}', '{"a":1} x', "", '{"a":1}]}'):
        assert one(spark, json_value(F.col("v")).isNull(), broken), broken
    assert one(spark, F.to_json(json_value(F.col("v"))), ' {"a":[1]} ') == '{"a":[1]}'


def chunked(spark, text, target):
    return one(spark, chunking.document_chunks(F.col("v"), target), text)


def test_chunks_keep_sections_and_size(spark):
    found = chunked(spark, "# Intro\n\nFirst paragraph.\n\nSecond paragraph.", 6)
    assert [c["section"] for c in found] == ["Intro", "Intro"]
    assert all(c["token_estimate"] <= 6 for c in found)
    assert chunked(spark, "", 5) == [] and chunked(spark, "# Only a heading", 5) == [] and chunked(spark, None, 5) is None
    slices = chunked(spark, "x" * 100, 5)
    assert "".join(c["text"] for c in slices) == "x" * 100


@pytest.mark.parametrize(
    ("text", "target", "expected"),
    [
        ("a\nb\n\n#\nc\n## \n", 40, [(None, "a b\n\n# c ##")]),
        ("one. two! three", 2, [(None, "one. two!"), (None, "three")]),
        ("one. two! three", 3, [(None, "one. two!"), (None, "three")]),
        ("ab. " + "z" * 9 + " c. d.", 1, [(None, "ab."), (None, "zzzz"), (None, "zzzz"), (None, "z c."), (None, "d.")]),
        ("# A\nx\r\n# B\ny", 40, [("A", "x\n\ny")]),
        ("#no\n###### Six\n####### seven", 40, [("Six", "#no\n\n####### seven")]),
    ],
)
def test_chunks_of_lines_and_sentences(spark, text, target, expected):
    assert [(c["section"], c["text"]) for c in chunked(spark, text, target)] == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("2024-01-05T10:00:00+05:30:15", "2024-01-05T04:29:45+00:00"),
        ("2024-01-05T10:00:00-0330", "2024-01-05T13:30:00+00:00"),
        ("seen 10000000005 days ago", None),
        ("999999999999999999999 days ago", None),
    ],
)
def test_offsets_and_long_numbers(spark, raw, expected):
    found = one(spark, F.date_format(dates.evidence_timestamp(F.col("v"), F.lit(NOW).cast("timestamp")), "yyyy-MM-dd'T'HH:mm:ssxxx"), raw)
    assert found == expected


@pytest.mark.parametrize(
    ("raw", "whole", "real"),
    [
        ("5", 5, 5.0), (" 7 ", 7, 7.0), ("5.0", 5, 5.0), ("-3.", -3, -3.0), ("5.5", None, 5.5), ("5d", None, None), ("5f", None, None), ("1e3", 1000, 1000.0),
        ("9007199254740993", 9007199254740993, 9007199254740992.0), ("9223372036854775807", 9223372036854775807, 9.223372036854775807e18),
        ("9223372036854775808", None, 9.223372036854775808e18), ("", None, None), ("x", None, None), ("1e30", None, 1e30), ("inf", None, float("inf")),
    ],
)
def test_numbers_of_texts(spark, raw, whole, real):
    assert one(spark, text.whole_number(F.col("v")), raw) == whole
    assert one(spark, text.number(F.col("v")), raw) == real


@pytest.mark.parametrize(("year", "expected"), [('"2001"', 2001), ('"2001d"', None), ("2001.0", 2001), ("true", None), ('"9007199254740993"', 9007199254740993)])
def test_integer_facts_are_exact(spark, year, expected):
    found = one(spark, facts(F.col("v"), "startup"), '{"founded_year":' + year + "}")
    assert (found and found["founded_year"]) == expected


@pytest.mark.parametrize(
    "written, expected",
    [("1990-04-01", 1990), ("1990", 1990), ("19900401", 1990), ("1990123", 1990), ("199004", 1990), ("18000-04-01", None), ("200012345", None)],
)
def test_founding_year_has_four_digits(spark, written, expected):
    node = F.parse_json(F.lit(f'{{"foundingDate":"{written}"}}'))
    assert spark.range(1).select(directory.founding_year(node).alias("y")).first()["y"] == expected
