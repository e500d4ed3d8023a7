"""Tables, files, catalogs and exports."""

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodegate.operators import export
from lodegate.operators.records import violations
from lodegate.operators.storage import insert_new, inserted_flags, raw_documents, read_table, write_batch, write_raw
from lodegate.sources import catalog, tables


def test_insert_new_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "record_id string, position int")
    assert {r["position"] for r in insert_new(rows, path, "record_id", "position").filter("inserted").collect()} == {1, 3}
    assert insert_new(rows, path, "record_id", "position").filter("inserted").count() == 0
    assert read_table(spark, path).count() == 2


def test_rows_wider_than_their_input_are_not_broadcast(spark, tmp_path):
    """A key in a file becomes a long payload, which the planner takes for small; flags must not send it to the driver."""
    path = str(tmp_path / "keys")
    spark.range(100).write.parquet(path)
    rows = spark.read.parquet(path).select("id", F.col("id").cast("string").alias("record_id"), F.repeat(F.lit("x"), 5000).alias("payload"))
    flagged = inserted_flags(rows, None, "record_id", "id").filter("inserted")
    assert "Broadcast" not in flagged._jdf.queryExecution().executedPlan().toString()
    assert flagged.count() == 100


def test_raw_evidence_is_written_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    responses = spark.createDataFrame(
        [("s", "http://a.com/x?utm_id=1", 200, {"content-type": "text/html; x"}, bytearray(b"<p>"), "2026-09-11 10:00:00")],
        "source_id string, request_url string, status_code int, headers map<string,string>, body binary, at string",
    ).select("*", F.col("request_url").alias("response_url"), F.col("at").cast("timestamp").alias("retrieved_at"))
    documents = raw_documents(responses.unionByName(responses))
    write_raw(documents, path)
    write_raw(documents, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 1
    row = stored.first()
    assert row["canonical_url"] == "https://a.com/x"
    assert row["storage_key"] == f"s/2026/09/11/{row['content_hash']}.html"
    assert bytes(tables.read_body(stored, row["storage_key"]).first()["body"]) == b"<p>"
    assert [f.name for f in Path(path).glob("source_id=s/year=2026/month=*")] == ["month=09"] or stored.select("month").first()[0] == 9


def test_raw_evidence_of_one_time_is_chosen_alike(spark, tmp_path):
    """Of equal ids the earliest response is written, and of those of one time the same whatever their order."""
    rows = [
        ("s", f"http://a.com/x?utm_id={n}", 200 + n % 2, {"etag": str(n)}, bytearray(b"<p>"), f"2026-09-11 10:00:0{second}")
        for n, second in ((1, 5), (2, 3), (3, 3), (4, 3), (5, 9))
    ]
    written = []
    for turn, given in enumerate((rows, rows[::-1])):
        responses = spark.createDataFrame(
            given, "source_id string, request_url string, status_code int, headers map<string,string>, body binary, at string"
        ).select("*", F.col("request_url").alias("response_url"), F.col("at").cast("timestamp").alias("retrieved_at"))
        path = str(tmp_path / str(turn))
        write_raw(raw_documents(responses.repartition(3)).withColumn("row", F.lit(1)), path)
        written.append([(r["original_url"], r["status_code"], r["headers"], r["row"]) for r in spark.read.parquet(path).collect()])
    assert written[0] == written[1] == [("http://a.com/x?utm_id=2", 200, {"etag": "2"}, 1)]


def test_json_lines_modes(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"rawName":"a"}\n\nbroken\n{"rawName":"b"}\n')
    assert tables.json_lines(spark, str(path), "rawName string", strict=False).count() == 2
    with pytest.raises(Exception):
        tables.json_lines(spark, str(path), "rawName string", strict=True).collect()


def test_seed_file_skips_bad_items(spark, tmp_path):
    path = tmp_path / "seeds.json"
    path.write_text(json.dumps([
        {"canonicalEntityId": "a", "rawEntityName": "A", "aliases": ["x", 5]}, {"rawEntityName": "no id"}, 7,
        {"canonicalEntityId": 3, "rawEntityName": "number"},
    ]))
    assert [tuple(r) for r in tables.seed_file(spark, str(path)).collect()] == [("a", "A", ["x"])]
    path.write_text("{}")
    with pytest.raises(Exception):
        tables.seed_file(spark, str(path)).collect()


def test_starter_seeds(spark):
    seeds = {r["entity_id"]: r["canonical_name"] for r in tables.starter_seeds(spark).collect()}
    assert len(seeds) == 50
    assert seeds["startup:weights-and-biases"] == "Weights & Biases"


def test_catalog_filters_and_settings(spark, tmp_path, monkeypatch):
    path = tmp_path / "sources.yaml"
    path.write_text(
        "sources:\n- {id: f, name: F, record_type: news, enabled: true, feed_url: 'http://f'}\n"
        "- {id: g, name: G, record_type: news, enabled: false, feed_url: 'http://g'}\n"
        "- {id: d, name: D, record_type: startup, enabled: true, listing_url: 'http://d'}\n"
        "- {id: e, name: E, record_type: startup, enabled: true}\n"
    )
    listed = catalog.read_catalog(spark, str(path))
    assert [r["id"] for r in catalog.feed_sources(listed, "news").collect()] == ["f"]
    (row,) = catalog.directory_sources(listed, "startup").collect()
    assert (row["id"], row["page_size"], row["max_records"]) == ("d", 100, 1000)
    assert catalog.source(listed, "e")["name"] == "E"
    with pytest.raises(ValueError):
        catalog.source(listed, "missing")
    monkeypatch.setenv("LODEGATE_BURST", "3")
    assert catalog.Settings.load().burst == 3


def test_csv_export(spark, tmp_path):
    news = spark.createDataFrame([(1, "Fresh, new", None), (2, 'say "hi"', True)], "id int, title string, ok boolean")
    paths = export.write_csv({"News": news}, str(tmp_path))
    rows = []
    for part in sorted(Path(paths["News"]).glob("*.csv")):
        rows += list(csv.DictReader(part.open(newline="")))
    assert rows == [{"id": "1", "title": "Fresh, new", "ok": ""}, {"id": "2", "title": 'say "hi"', "ok": "True"}]
    assert list(paths) == list(export.REQUIRED_TABS)
    for tab in export.REQUIRED_TABS:
        if tab != "News":
            assert "".join(p.read_text() for p in Path(paths[tab]).glob("*.csv")).split() == ["record"]
    with pytest.raises(ValueError):
        export.write_csv({"Unknown": news}, str(tmp_path))


def test_nested_cells_are_sorted_json(spark):
    rows = spark.createDataFrame([(0, '{"recordId":"one","content":{"title":"AI","a":"é"}}')], "n int, payload string")
    cells = export.payload_cells(rows, "payload").first()["cells"]
    assert cells == {"recordId": "one", "content": '{"a": "\\u00e9", "title": "AI"}'}


def test_sheet_requests(spark):
    assert export.missing_tabs(["News", "Jobs"]) == ["Startups", "Products", "Research Papers", "Entity Mapping Log"]
    assert export.add_sheet_requests(export.REQUIRED_TABS) is None
    rows = spark.range(5).select("id", F.create_map(F.lit("k"), F.col("id").cast("string")).alias("cells"))
    sent = sorted((r["batch"], json.loads(r["request"])) for r in export.value_ranges("News", rows, "cells", "id", 2).collect())
    assert [(r["range"], r["values"]) for _, r in sent] == [
        ("'News'!A1", [["k"]]), ("'News'!A2", [["0"], ["1"]]), ("'News'!A4", [["2"], ["3"]]), ("'News'!A6", [["4"]]),
    ]


def base_record(**changes):
    record = {
        "recordId": "r", "schemaVersion": "1.0", "recordType": "NEWS",
        "source": {"name": "s", "url": "http://a.b/", "canonicalUrl": "https://a.b/"},
        "collectedAt": "2026-09-11T00:00:00Z",
        "provenance": {
            "retrievedAt": "2026-09-11T00:00:00Z", "contentHash": "a" * 64, "rawDocumentId": "d",
            "extractionMethod": "deterministic", "extractionMetadata": {}, "validationStatus": "VALID",
        },
        "content": {"title": "t", "publishedDate": "2026-09-11T00:00:00Z", "body": "b"},
        "freshness": {"ageHours": 3.5, "dateSource": "rss", "dateConfidence": 0.85, "isFresh": True},
    }
    return json.dumps({**record, **changes})


@pytest.mark.parametrize(
    ("changes", "problems"),
    [
        ({}, []),
        ({"freshness": {"age_hours": 24, "date_source": "rss", "dateConfidence": 1, "isFresh": True}}, []),
        ({"freshness": {"ageHours": 24.5, "dateSource": "rss", "dateConfidence": 1, "isFresh": True}}, ["freshness.ageHours:invalid"]),
        ({"freshness": {"ageHours": 1, "dateSource": "guess", "dateConfidence": 1, "isFresh": False}},
         ["freshness.dateSource:invalid", "freshness.isFresh:invalid"]),
        ({"content": {"title": "", "publishedDate": "2026-09-11T00:00:00", "body": "b", "more": 1}},
         ["content.more:unknown", "content.publishedDate:invalid", "content.title:invalid"]),
        ({"source": None}, ["source.canonicalUrl:missing", "source.name:missing", "source.url:missing", "source:missing"]),
    ],
)
def test_news_rules(spark, changes, problems):
    frame = spark.createDataFrame([(base_record(**changes),)], "payload string")
    assert frame.select(violations(F.col("payload"), "NEWS")).first()[0] == problems


def test_stored_log_is_exported_in_the_order_it_was_appended(spark, tmp_path):
    root, out = str(tmp_path / "tables"), str(tmp_path / "out")
    rows = [("z", 1, "r1"), ("a", 2, "r2"), ("m", 3, "r3")]
    log = spark.createDataFrame(rows, "rawName string, mappingId long, recordId string")
    later = spark.createDataFrame([("b", 1, "r4"), ("again", 2, "r1")], log.schema)
    for batch, given in ((1, log), (2, later), (2, later)):
        write_batch(given, f"{root}/entity_mapping_log", batch, "recordId", "mappingId")
    paths = export.write_csv(tables.read_tabs(spark, root), out)
    shown = spark.read.option("header", True).csv(paths["Entity Mapping Log"])
    assert shown.columns == ["rawName", "recordId"]
    parts = sorted(Path(paths["Entity Mapping Log"]).glob("part-*.csv"))
    names = [row["rawName"] for part in parts for row in csv.DictReader(part.open())]
    assert names == ["z", "a", "m", "b"]
