"""Retry, fallback and worker decisions as column rules."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, functions as F

# Job types a worker knows.
JOB_TYPES = (
    "DISCOVER_SOURCE", "FETCH_URL", "PARSE_DOCUMENT", "EXTRACT_ENTITY", "RESOLVE_ENTITY", "FETCH_GITHUB", "EXPORT_RECORD",
)


def is_transient_status(status: Column) -> Column:
    return (status == 429) | status.between(500, 599)


def falls_back(status: Column, retryable: Column, timed_out: Column) -> Column:
    """Whether a failed provider call moves on to the next provider."""
    by_status = F.coalesce(status.isin(413, 429) | (status >= 500), F.lit(False))
    return F.coalesce(retryable, F.lit(False)) | by_status | F.coalesce(timed_out, F.lit(False))


def backoff_seconds(
    failed_attempt: Column, *, base: float, cap: float, retry_after: Column | None = None
) -> Column:
    """Delay after the n-th failed attempt (n from 1), without jitter."""
    delay = F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), failed_attempt - 1))
    return delay if retry_after is None else F.greatest(delay, F.coalesce(retry_after, F.lit(0.0)))


def worker_outcome(
    job_type: Column,
    error_type: Column,
    attempts: Column,
    *,
    known_types: Collection[str] = JOB_TYPES,
    max_retries: int = 3,
    base: float = 0.5,
    cap: float = 8.0,
) -> Column:
    """Struct (outcome, reason, delay_seconds) for one delivery of a job.

    ``error_type`` is the name of the failure, null on success.
    """
    known = F.coalesce(job_type.isin(*known_types), F.lit(False))
    spent = attempts >= max_retries
    outcome = (
        F.when(~known, "dead_lettered").when(error_type.isNull(), "processed").when(spent, "dead_lettered").otherwise("retried")
    )
    reason = F.when(~known, "unknown_job_type").when(
        error_type.isNotNull() & spent, F.concat(F.lit("max_retries:"), error_type)
    )
    delay = F.when(outcome == "retried", backoff_seconds(attempts + 1, base=base, cap=cap))
    return F.struct(outcome.alias("outcome"), reason.alias("reason"), delay.alias("delay_seconds"))
