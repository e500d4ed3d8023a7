"""Streams of many files against one sequential pass over all rows."""

import random
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from lodegate.streaming.gate import claim_batch, claim_store, ingest_stream, watermarks
from lodegate.streaming.runs import RunStore, runs_of
from tests.test_operators import sequential_claim

NOW = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)


def test_runs_cover_all_batches():
    for batches in range(200):
        runs = runs_of(batches)
        assert [b for first, last in runs for b in range(first, last + 1)] == list(range(batches))
        assert len(runs) <= batches.bit_length()


def store_of(spark, path, buckets=4):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    return RunStore(spark, str(path), schema, "k", lambda rows: rows.groupBy("k").agg(F.max("n").alias("n")), buckets)


def test_store_repeats_a_batch(spark, tmp_path):
    store, expected = store_of(spark, tmp_path / "s"), {}
    for batch in range(6):
        rows = spark.createDataFrame([(f"k{(batch * 3 + j) % 7}", batch * 10 + j) for j in range(3)], "k string, n long")
        for _ in range(2):  # the second time as after a failure
            assert {r["k"]: r["n"] for r in store.before(batch).collect()} == expected
            store.write(rows, batch)
        for row in rows.collect():
            expected[row["k"]] = max(expected.get(row["k"], -1), row["n"])
    assert {r["k"]: r["n"] for r in store.all().collect()} == expected
    assert len(store.stored_runs()) <= 4
    wanted = store.before(6, spark.createDataFrame([("k1", 0)], "k string, n long"))
    assert {r["k"] for r in wanted.collect()} < set(expected) and "k1" in {r["k"] for r in wanted.collect()}
    assert "PartitionFilters: [isnotnull(bucket" in wanted._jdf.queryExecution().executedPlan().toString()


def test_claims_of_a_repeated_batch(spark, tmp_path):
    chance = random.Random(3)
    rows = [(i, f"u{chance.randrange(30)}", f"h{chance.randrange(30)}") for i in range(120)]
    won = set()
    for batch in range(3):
        part = spark.createDataFrame(rows[batch * 40 : batch * 40 + 40], "position long, u string, h string")
        for _ in range(1 + (batch == 1)):
            claimed = claim_batch(part, batch, str(tmp_path / "state"), url_key="u", content_key="h", order="position")
            got = {r["position"] for r in claimed.filter("claimed").collect()}
        won |= got
    assert won == sequential_claim(rows)


def test_stream_of_twenty_files(spark, tmp_path):
    chance = random.Random(9)
    rows, files = [], tmp_path / "in"
    schema = "position long, source_id string, published_at timestamp, date_source string, date_confidence double, url_key string, content_key string"
    for file in range(20):
        part = []
        for _ in range(6):
            age = timedelta(minutes=chance.randrange(30 * 60))
            part.append((len(rows) + len(part), f"s{chance.randrange(3)}", NOW - age, "json_ld", 0.99, f"u{chance.randrange(60)}", f"h{chance.randrange(80)}"))
        rows += part
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(files / f"f{file:02d}"))
    # One file per batch, in the order of writing.
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(files / "*"))
    state = str(tmp_path / "state")
    ingest_stream(stream, state, F.lit(NOW)).awaitTermination()
    decided = {r["position"]: r for r in spark.read.parquet(f"{state}/decisions").collect()}
    assert decided.keys() == {r[0] for r in rows}
    fresh = [(r[0], r[5], r[6]) for r in rows if r[2] >= NOW - timedelta(hours=24)]
    assert {p for p, r in decided.items() if r["status"] == "ACCEPT"} == {p for p, *_ in fresh}
    won = {p for p, r in decided.items() if r["claimed"]}
    assert won == sequential_claim(fresh)
    latest = {}
    for row in rows:
        if row[0] in won:
            latest[row[1]] = max(latest.get(row[1], row[2]), row[2])
    assert {r["source_id"]: r["watermark"].replace(tzinfo=timezone.utc) for r in watermarks(spark, state, "source_id").collect()} == latest
    # What a batch reads is bounded by the runs: 20 batches are two runs, and what the last one merged.
    assert len(claim_store(spark, state, "url_key").stored_runs()) <= 5
    assert len(list(Path(state).glob("claimed-url_key/run=*"))) <= 5


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_empty_batches(spark, tmp_path, batches):
    store = store_of(spark, tmp_path / "e")
    for batch in range(batches):
        store.write(spark.createDataFrame([], store.schema), batch)
    assert store.all().count() == 0
