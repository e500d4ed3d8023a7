"""Streaming ingestion: gate, claim, watermark and persist one micro-batch at a time.

State lives next to the output: what a batch decided in a folder of its own, keys and watermarks
in merged runs (see ``runs``). A batch that is run again after a failure replaces its own attempt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lodegate.operators.dedupe import claim
from lodegate.operators.freshness import advance_watermarks, freshness_decision
from lodegate.session import materialize
from lodegate.streaming.runs import RunStore


def gated(stream: DataFrame, now: Column, *, max_age_hours: float = 24.0, min_confidence: float = 0.75) -> DataFrame:
    """Stateless part: adds the decision struct. Late rows keep their reason."""
    decision = freshness_decision(
        F.col("published_at"), F.col("date_source"), F.col("date_confidence"), now,
        max_age_hours=max_age_hours, min_confidence=min_confidence,
    )
    return stream.withColumn("decision", decision)


def write_batch(rows: DataFrame, path: str, batch: int) -> None:
    """Write one batch's rows; writing the same batch again replaces them."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def claim_store(spark: SparkSession, state: str, key: str) -> RunStore:
    """Keys of one kind that were claimed."""
    return RunStore(spark, f"{state}/claimed-{key}", T.StructType([T.StructField(key, T.StringType())]), key, DataFrame.distinct)


def watermark_store(spark: SparkSession, state: str, source: str) -> RunStore:
    schema = T.StructType([T.StructField(source, T.StringType()), T.StructField("watermark", T.TimestampType())])
    latest = lambda rows: rows.groupBy(source).agg(F.max("watermark").alias("watermark"))
    return RunStore(spark, f"{state}/watermarks", schema, source, latest, buckets=4)


def claim_batch(
    rows: DataFrame, batch: int, state: str, *, url_key: str, content_key: str, order: str
) -> DataFrame:
    """Two-key claim of a batch against the keys of all earlier batches.

    Of the stored keys only the buckets are read that keys of this batch fall into.
    """
    stores = {key: claim_store(rows.sparkSession, state, key) for key in (url_key, content_key)}
    seen = {key: store.before(batch, rows.select(key).filter(F.col(key).isNotNull())) for key, store in stores.items()}
    claimed = claim(rows, url_key, content_key, order, seen_urls=seen[url_key], seen_contents=seen[content_key])
    claimed = materialize(claimed, "stream-claim")
    for key, store in stores.items():
        store.write(claimed.filter("claimed").select(key), batch)
    return claimed


def watermark_batch(accepted: DataFrame, batch: int, state: str, source: str, published_at: str) -> None:
    """Store the watermarks reached after this batch."""
    reached = advance_watermarks(None, accepted, source, published_at)
    watermark_store(accepted.sparkSession, state, source).write(reached, batch)


def watermarks(spark: SparkSession, state: str, source: str) -> DataFrame:
    return watermark_store(spark, state, source).all()


def ingest_stream(
    stream: DataFrame,
    state: str,
    now: Column,
    *,
    source: str = "source_id",
    url_key: str = "url_key",
    content_key: str = "content_key",
    order: str = "position",
    on_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Gate, claim and store a stream of candidates until its input is used up.

    ``state`` holds the accepted rows (accepted) and all decisions (decisions) by batch, and as
    merged runs the claimed keys (claimed-<key>) and the source watermarks (watermarks).
    """

    def handle(rows: DataFrame, batch: int) -> None:
        decided = materialize(rows, "stream-batch")
        fresh = decided.filter(F.col("decision.status") == "ACCEPT")
        claimed = claim_batch(fresh, batch, state, url_key=url_key, content_key=content_key, order=order)
        accepted = claimed.filter("claimed").drop("claimed")
        write_batch(accepted, f"{state}/accepted", batch)
        watermark_batch(accepted, batch, state, source, "published_at")
        flags = claimed.select(order, "claimed")
        outcome = decided.join(flags, [order], "left").select(
            order, source, F.col("decision.status").alias("status"), F.col("decision.reason").alias("reason"),
            F.coalesce("claimed", F.lit(False)).alias("claimed"),
        )
        write_batch(outcome, f"{state}/decisions", batch)
        if on_batch is not None:
            on_batch(accepted, batch)

    return (
        gated(stream, now)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
