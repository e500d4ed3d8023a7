"""Job queue as a stream: deliveries, retries and dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lodegate.functions.retrying import JOB_TYPES, worker_outcome
from lodegate.session import materialize
from lodegate.streaming.gate import write_batch

JOB = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("job_type", T.StringType()),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
        T.StructField("attempts", T.IntegerType()),
    ]
)


def encode_job(job_id: Column, job_type: Column, payload: Column, attempts: Column) -> Column:
    """JSON text of a job, keys in alphabetical order."""
    return F.to_json(
        F.struct(attempts.alias("attempts"), job_id.alias("job_id"), job_type.alias("job_type"), payload.alias("payload"))
    )


def decode_job(text: Column) -> Column:
    job = F.from_json(text, JOB)
    return F.when(job.isNotNull(), job.withField("attempts", F.coalesce(job["attempts"], F.lit(0))))


class Handlers:
    """Handlers by job type; one handler per type.

    A handler adds error_type, null on success. Jobs without a handler pass
    through and become dead letters.
    """

    def __init__(self) -> None:
        self._by_type: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def register(self, job_type: str, handler: Callable[[DataFrame], DataFrame]) -> None:
        if job_type not in JOB_TYPES:
            raise ValueError(f"Unknown job type {job_type!r}")
        if job_type in self._by_type:
            raise ValueError(f"A handler for {job_type} is already registered")
        self._by_type[job_type] = handler

    @property
    def types(self) -> tuple[str, ...]:
        return tuple(self._by_type)

    def __call__(self, jobs: DataFrame) -> DataFrame:
        known = F.coalesce(F.col("job_type").isin(*self._by_type), F.lit(False))
        columns = [*jobs.columns, "error_type"]
        done = jobs.filter(~known).withColumn("error_type", F.lit(None).cast("string"))
        for job_type, handler in self._by_type.items():
            done = done.unionByName(handler(jobs.filter(F.col("job_type") == job_type)).select(*columns))
        return done


def run_workers(
    jobs: DataFrame, handlers: Handlers, folder: str, *, max_retries: int = 3
) -> StreamingQuery:
    """Run a stream of decoded jobs through the handlers of their types.

    Each batch leaves its processed jobs, retries (attempts raised, with a delay) and dead letters
    (with a reason) under ``folder``. A batch repeated after a failure replaces
    its files, so every delivery is recorded once; the source's offsets in the
    checkpoint stand for acknowledgements.
    """

    def handle(batch_jobs: DataFrame, batch: int) -> None:
        outcome = worker_outcome(
            F.col("job_type"), F.col("error_type"), F.col("attempts"), known_types=handlers.types, max_retries=max_retries
        )
        told = handlers(batch_jobs).select(*JOB.fieldNames(), outcome.alias("o")).select(*JOB.fieldNames(), "o.*")
        told = materialize(told, "jobs")
        split = lambda name: told.filter(F.col("outcome") == name)
        write_batch(split("processed").select(*JOB.fieldNames()), f"{folder}/processed", batch)
        write_batch(
            split("retried").select(*JOB.fieldNames(), "delay_seconds").withColumn("attempts", F.col("attempts") + 1),
            f"{folder}/retries", batch,
        )
        write_batch(split("dead_lettered").select(*JOB.fieldNames(), "reason"), f"{folder}/dead_letters", batch)

    return (
        jobs.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
