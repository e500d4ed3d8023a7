"""Steps whose cost or memory must follow the input."""

import pyarrow as pa
from pyspark.sql import functions as F

from lodegate.functions import markup
from lodegate.functions.binding import let
from lodegate.functions.dates import date_evidence
from lodegate.functions.identity import _address, _repository, repository_url
from lodegate.operators import ingest
from lodegate.plans.documents import feed_items


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_feeds_are_parsed_once(spark):
    assert plan(feed_items(spark, "/root/testdata/sf0.001")).count("ArrowEvalPython") == 1


def test_bound_values_are_taken_out_of_no_array(spark):
    rows = spark.createDataFrame([("2024-01-05",), (None,)], "v string")
    dated = rows.select(date_evidence(F.lit("2024-01-30 12:00:00+00:00").cast("timestamp"), rss=F.col("v"))["source"].alias("r"))
    assert "transform(" not in plan(dated)
    assert [r["r"] for r in dated.collect()] == ["rss", None]
    assert [r["r"] for r in rows.select(let(F.col("v"), lambda v: F.coalesce(v, F.lit("none"))).alias("r")).collect()] == ["2024-01-05", "none"]


def test_events_of_a_batch_are_held_in_slices(monkeypatch):
    monkeypatch.setattr(markup, "EVENTS_AT_ONCE", 40)
    pages = pa.array(["<p>one</p>", None, "<p>" + "two " * 30 + "</p>", "", "<p>three</p>", "<p>four</p>", "<p>five</p>", "<p>six</p>"])
    slices = list(markup._some_pages(pages))
    assert [len(s) for s in slices] == [2, 1, 4, 1]
    assert pa.concat_arrays(slices) == pages
    assert sum(map(len, markup._some_pages(pages.slice(0, 0)))) == 0
    whole = pa.concat_arrays([markup._events(s) for s in slices])
    assert whole.to_pylist() == markup._events(pages).to_pylist()


def test_paper_candidates_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)
    count = F.udf(lambda value: made.add(1) or value, "long").asNondeterministic()
    paper = """'papers' AS source_id, concat('https://p.example.org/', id) AS canonical_url, concat('https://p.example.org/', id) AS original_url, concat('own', id) AS raw_document_id,
      repeat('a', 64) AS content_hash, timestamp '2024-01-05 11:00:00' AS retrieved_at, cast(id AS string) AS arxiv_id, concat('https://arxiv.org/abs/', id) AS paper_url, concat('Title ', id) AS title"""
    empty = "cast(array() AS array<string>) AS authors, cast(null AS timestamp) AS published_at, cast(null AS string) AS abstract"
    link = "concat('http://www.github.com/C', id % 4, '/R.git') AS github_url"
    candidates = spark.sql(f"SELECT id, {paper}, {empty}, {link} FROM range(20)").withColumn("id", count("id"))
    told = "cast(id AS string) AS arxiv_id, concat('https://arxiv.org/abs/', id) AS paper_url, 'T' AS title, array('A') AS authors, timestamp '2024-01-02 00:00:00' AS published_at, 'x' AS abstract, concat('bib', id) AS raw_document_id"
    bibliography = spark.sql(f"SELECT {told} FROM range(18)")
    repositories = spark.sql("SELECT concat('https://github.com/c', id, '/r') AS normalized_url, 'n' AS full_name, id AS stars FROM range(3)")
    stored = spark.sql("SELECT concat('own', id) AS raw_document_id FROM range(20) UNION ALL SELECT concat('bib', id) FROM range(16)")
    rows = ingest.paper_records(candidates, bibliography, repositories, "id", raw_documents=stored).collect()
    reasons = {r["id"]: r["reject_reason"] for r in rows}
    assert reasons == {
        i: "metadata_missing" if i >= 18 else "repository_unverified" if i % 4 == 3 else "raw_document_missing" if i >= 16 else None
        for i in range(20)
    }
    assert made.value == 20


def test_plain_repository_addresses_follow_the_general_rules(spark):
    names = ("a/b", "A/b.git", "a/.git", "a/b.git.git", "a/b/", "a/b.git/", "a//b", "a/b//", "a/b/c", "a", "a/b?x=1", "a/b#r", "a/b\n", "a/b\n/", "a /b", "a/%62", "./..")
    hosts = ("http://github.com/", "https://www.github.com/", "HTTPS://GitHub.com/", "https://github.com:443/", "https://u@github.com/", "https://github.com.org/", " https://github.com/", "ftp://github.com/")
    rows = spark.createDataFrame([(host + name,) for host in hosts for name in names] + [(None,), ("",)], "url string")
    told = rows.select("url", repository_url(F.col("url")).alias("now"), _address(F.col("url"), _repository).alias("rule")).collect()
    assert [(r["url"], r["now"]) for r in told] == [(r["url"], r["rule"]) for r in told]
    assert {r["now"] for r in told} >= {None, "https://github.com/a/b", "https://github.com/a/b.git"}
