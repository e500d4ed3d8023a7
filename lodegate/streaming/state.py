"""Token bucket and circuit breaker over streams of requests.

Each micro-batch runs the batch operators from the state the batches before it
left. The state is one row per host or provider, and a host that sends most of
a batch is scanned in slices, so no key is bound to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lodegate.operators.limits import circuit_breaker, token_bucket
from lodegate.operators.storage import read_table
from lodegate.session import materialize
from lodegate.streaming.gate import write_batch


def _last_state(spark, path: str, key: str, batch: int) -> DataFrame | None:
    """Newest state row per key from earlier batches."""
    stored = read_table(spark, path)
    if stored is None:
        return None
    columns = [c for c in stored.columns if c not in (key, "batch")]
    newest = F.max_by(F.struct(*columns), "batch").alias("s")
    return stored.filter(F.col("batch") < batch).groupBy(key).agg(newest).select(key, "s.*")


def _run(stream: DataFrame, folder: str, handle) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def token_bucket_stream(
    requests: DataFrame, folder: str, host: str, at_micros: str, order: str, *, rate_per_second: float, burst: int
) -> StreamingQuery:
    """Write the grants of every batch to folder/grants."""

    def handle(rows: DataFrame, batch: int) -> None:
        carried = _last_state(rows.sparkSession, f"{folder}/buckets", host, batch)
        granted = materialize(
            token_bucket(rows, host, at_micros, order, rate_per_second=rate_per_second, burst=burst, carried=carried),
            "grants",
        )
        write_batch(granted, f"{folder}/grants", batch)
        write_batch(granted.groupBy(host).agg(F.max("full_at_micros").alias("full_at_micros")), f"{folder}/buckets", batch)

    return _run(requests, folder, handle)


def circuit_breaker_stream(
    calls: DataFrame, folder: str, provider: str, at_micros: str, order: str, failed: str, **limits: float
) -> StreamingQuery:
    """Write the replayed calls of every batch to folder/calls."""

    def handle(rows: DataFrame, batch: int) -> None:
        carried = _last_state(rows.sparkSession, f"{folder}/circuits", provider, batch)
        replayed = materialize(
            circuit_breaker(rows, provider, at_micros, order, failed, carried=carried, **limits), "calls"
        )
        write_batch(replayed, f"{folder}/calls", batch)
        last = replayed.groupBy(provider).agg(
            F.max_by(F.struct("failures", "opened_at"), F.struct(at_micros, order)).alias("s")
        )
        write_batch(last.select(provider, "s.*"), f"{folder}/circuits", batch)

    return _run(calls, folder, handle)
