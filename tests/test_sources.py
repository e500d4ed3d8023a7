"""Adapters, job handlers and feed details."""

import pytest
from pyspark.sql import functions as F

from lodegate.functions.readers import read_feed
from lodegate.sources import feeds
from lodegate.sources.adapters import Adapter, default_adapters
from lodegate.streaming.queue import Handlers


def now():
    return F.lit("2026-09-11 12:00:00+00:00").cast("timestamp")


def documents(spark, *bodies):
    frame = spark.createDataFrame(list(enumerate(bodies)), "position int, text string")
    return frame.select("position", F.encode("text", "UTF-8").alias("body"))


RSS = (
    "<rss><channel><item><title>AI launch</title><link>https://example.com/story</link><description>Details</description>"
    "<pubDate>Fri, 11 Sep 2026 11:00:00 GMT</pubDate><author>Acme</author></item></channel></rss>"
)


def test_feed_item_keeps_date_evidence(spark):
    (item,) = feeds.feed_items(documents(spark, RSS), "body", now()).collect()
    assert (item["date_source"], item["date_confidence"], item["author"]) == ("rss", 0.85, "Acme")


def test_namespaced_atom_yields_no_feed_items(spark):
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>t</title><link href="http://a.b/"/><content>c</content></entry></feed>'
    plain = atom.replace(' xmlns="http://www.w3.org/2005/Atom"', "")
    assert [r["position"] for r in feeds.feed_items(documents(spark, atom, plain), "body", now()).collect()] == [1]


def test_adapters_by_id(spark):
    known = default_adapters()
    assert {a.record_type for a in known} == {"research_paper", "startup", "product", "news", "job"}
    with pytest.raises(ValueError):
        known.register(Adapter("arxiv", "again", "news", lambda d: d, lambda d, n: d))
    with pytest.raises(ValueError):
        known.get("missing")
    listing = spark.createDataFrame([("https://www.ycombinator.com/companies", 100, 201)], "listing_url string, page_size long, max_records long")
    urls = [r["url"] for r in known.get("ycombinator").pages(listing).orderBy("page").collect()]
    assert urls == [f"https://www.ycombinator.com/companies?page={n}" for n in (1, 2, 3)]
    (news,) = known.get("techcrunch_ai").parse(documents(spark, RSS), now()).collect()
    assert (news["title"], news["category"]) == ("AI launch", "AI")


def test_handlers_are_registered_once(spark):
    handlers = Handlers()
    handlers.register("FETCH_URL", lambda rows: rows.withColumn("error_type", F.lit(None).cast("string")))
    with pytest.raises(ValueError):
        handlers.register("FETCH_URL", lambda rows: rows)
    with pytest.raises(ValueError):
        handlers.register("CLEAN_UP", lambda rows: rows)


def test_quick_scan_is_spread_and_reads_entries_where_there_are_no_items(spark, tmp_path):
    item = "<item><title>T</title><link>http://a.b/</link><description>x <b>y</b></description></item>"
    entry = '<entry><title>E</title><link rel="x" href="http://e.f/g"/><summary>s</summary></entry>'
    texts = [(0, item + entry + "<item><title>none</title></item>" + item), (1, entry), (2, "nothing")]
    spark.createDataFrame(texts, "position int, xml string").coalesce(1).write.parquet(f"{tmp_path}/feeds")
    frame = spark.read.parquet(f"{tmp_path}/feeds")
    scanned = feeds.first_items(frame, "position", "xml")
    assert sorted(tuple(r) for r in scanned.collect()) == [
        (0, 0, "T", "https://a.b/", "x  y"), (0, 2, "T", "https://a.b/", "x  y"), (1, 0, "E", "https://e.f/g", "s"),
    ]
    assert scanned.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_first_field_of_any_namespace_counts():
    body = b'<rss xmlns:a="x" xmlns:b="y"><item><a:title>no</a:title><title/><title>late</title><a:date>1</a:date><b:date>2</b:date><link href=""/><a:link href="h"/></item></rss>'
    (row,) = read_feed(body)
    assert (row["title"], row["date"], row["link"], row["href"], row["author"]) == ("", "1", "", "h", None)


def test_parsed_feeds_serve_items_and_failures(spark, monkeypatch):
    parsed = feeds.parse_feeds(documents(spark, RSS, "<rss>", None), "body").localCheckpoint()
    monkeypatch.delattr(feeds, "feed_rows")  # nothing parses them again
    assert [r["position"] for r in feeds.feed_items(parsed, "body", now()).collect()] == [0]
    assert [tuple(r) for r in feeds.malformed_feeds(parsed, "body").collect()] == [(1,)]
