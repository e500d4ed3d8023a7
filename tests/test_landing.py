"""Landed responses as a data source, a sink and a stream, and batches that replace themselves."""

import pytest
from pyspark.sql import functions as F

from lodegate.operators.storage import first_responses, raw_documents, read_table, write_batch
from lodegate.sources.landing import LandedWriter, land, landed, landed_stream


def _documents(spark, rows):
    given = spark.createDataFrame(rows, "source_id string, request_url string, body binary, at string")
    return raw_documents(given.select(
        "source_id", "request_url", F.col("request_url").alias("response_url"), F.lit(200).alias("status_code"),
        F.create_map(F.lit("content-type"), F.lit("text/html")).alias("headers"), "body", F.col("at").cast("timestamp").alias("retrieved_at"),
    ))


FIRST = [
    ("a", "http://a.com/1", b"one", "2026-01-01 10:00:00"), ("a", "http://a.com/1", b"one", "2026-01-01 09:00:00"),
    ("a", "http://a.com/1", b"one", "2026-01-01 09:00:00"), ("b", "http://b.com/2", b"", "2026-01-02 10:00:00"),
]
SECOND = [("a", "http://a.com/1", b"one", "2026-01-03 10:00:00"), ("b", "http://b.com/3", b"x" * 9_000_000, "2026-01-02 10:00:00")]


def test_bodies_are_written_once_and_read_whole(spark, tmp_path):
    root = str(tmp_path / "store")
    land(_documents(spark, FIRST), root)
    land(_documents(spark, SECOND), root)
    land(_documents(spark, []), root)
    rows = landed(spark, root).collect()
    assert sorted((r["source_id"], bytes(r["body"])) for r in rows) == sorted((s, b) for s, _, b, _ in FIRST + SECOND)
    files = [p for p in (tmp_path / "store" / "bodies").rglob("*") if p.is_file()]
    assert len(files) == len({r["storage_key"] for r in rows}) == 4
    assert "body" not in landed(spark, root, bodies=False).columns
    assert landed(spark, root, run=2).count() == 2
    assert sorted(p.name for p in (tmp_path / "store" / "responses").iterdir() if p.is_dir()) == ["run=00000001", "run=00000002"]


def test_filters_reach_the_rows_before_bodies(spark, tmp_path):
    root = tmp_path / "store"
    land(_documents(spark, FIRST), str(root))
    for body in (root / "bodies" / "b").rglob("*.html"):
        body.unlink()
    assert landed(spark, str(root)).filter("source_id = 'a'").count() == 3
    assert landed(spark, str(root)).filter("source_id IN ('a', 'c') AND status_code = 200").count() == 3
    key = landed(spark, str(root), bodies=False).filter("source_id = 'a'").first()["storage_key"]
    assert {bytes(r["body"]) for r in landed(spark, str(root)).filter(F.col("storage_key") == key).collect()} == {b"one"}
    with pytest.raises(Exception, match="bodies/b"):
        landed(spark, str(root)).collect()


def test_no_run_gives_no_rows_and_overwriting_is_refused(spark, tmp_path):
    assert landed(spark, str(tmp_path / "none")).collect() == []
    root = str(tmp_path / "store")
    with pytest.raises(Exception, match="only appended"):
        _documents(spark, FIRST).write.format("landed").mode("overwrite").save(root)


def test_a_failed_run_publishes_nothing(spark, tmp_path):
    root = tmp_path / "store"
    land(_documents(spark, FIRST), str(root))
    with pytest.raises(Exception, match="storage key"):
        land(_documents(spark, SECOND).withColumn("storage_key", F.when(F.col("source_id") == "a", F.col("storage_key"))), str(root))
    with pytest.raises(Exception, match="no storage key"):
        land(_documents(spark, SECOND).withColumn("storage_key", F.lit("a/../../x")), str(root))
    assert landed(spark, str(root)).count() == len(FIRST)
    assert not list((root / "_staged").iterdir())


def test_files_of_lost_attempts_are_dropped(spark, tmp_path):
    root = str(tmp_path / "store")
    batches = landed(spark, root).limit(0).toArrow().to_batches()
    rows = _documents(spark, FIRST)
    land(rows, root)
    given = landed(spark, root).toArrow().to_batches()
    writer = LandedWriter(root)
    writer.write(iter(given))  # its message never came
    message = writer.write(iter(given))
    writer.commit([message, None, writer.write(iter(batches))])
    assert landed(spark, root, run=2).count() == len(FIRST)


def test_stream_reads_runs_in_order(spark, tmp_path):
    root, out = str(tmp_path / "store"), str(tmp_path / "out")
    land(_documents(spark, FIRST), root)
    seen = []

    def keep(batch, number):
        batch.write.mode("append").parquet(out)
        seen.append(number)

    def run():
        stream = landed_stream(spark, root).writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).start()
        try:
            stream.processAllAvailable()
        finally:
            stream.stop()

    run()
    assert spark.read.parquet(out).count() == len(FIRST)
    land(_documents(spark, SECOND), root)
    run()
    assert spark.read.parquet(out).count() == len(FIRST + SECOND)
    assert len(seen) == 2


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    root, table = str(tmp_path / "store"), str(tmp_path / "documents")
    for run, rows in ((1, FIRST), (2, SECOND)):
        land(_documents(spark, rows), root)
    for run in (1, 2, 2, 1):
        write_batch(first_responses(landed(spark, root, bodies=False, run=run)), table, run, "raw_document_id")
    rows = read_table(spark, table).select("canonical_url", "batch", F.date_format("retrieved_at", "HH").alias("hour"), "headers").collect()
    assert sorted((r["canonical_url"], r["batch"], r["hour"]) for r in rows) == [
        ("https://a.com/1", 1, "09"), ("https://b.com/2", 1, "10"), ("https://b.com/3", 2, "10"),
    ]
    assert rows[0]["headers"] == {"content-type": "text/html"}
