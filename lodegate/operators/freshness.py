"""Freshness gate, its counters and per-source publication watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodegate.functions.dates import age_hours
from lodegate.scale import lookup_join

# Fixed values of the gate.
MAX_AGE_HOURS = 24.0
MIN_CONFIDENCE = 0.75


def freshness_decision(
    published_at: Column,
    source: Column,
    confidence: Column,
    now: Column,
    *,
    max_age_hours: float = MAX_AGE_HOURS,
    min_confidence: float = MIN_CONFIDENCE,
) -> Column:
    """Struct (status, reason, published_at, source, confidence, age_hours).

    An unknown date comes first, then weak evidence, then the future, then age;
    both ends of the accepted age range are included.
    """
    age = age_hours(published_at, now)
    reason = (
        F.when(published_at.isNull(), "date_unresolved")
        .when(confidence < min_confidence, "low_confidence_date")
        .when(age < 0, "future_date")
        .when(age > max_age_hours, "stale_date")
        .otherwise("fresh")
    )
    status = (
        F.when(reason == "fresh", "ACCEPT")
        .when(reason.isin("future_date", "stale_date"), "REJECT")
        .otherwise("QUARANTINE")
    )
    dated = published_at.isNotNull()
    return F.struct(
        status.alias("status"),
        reason.alias("reason"),
        published_at.alias("published_at"),
        F.when(dated, source).alias("source"),
        F.when(dated, confidence).otherwise(F.lit(0.0)).alias("confidence"),
        age.alias("age_hours"),
    )


def reason_counts(decided: DataFrame, by: list[str], failures: DataFrame | None = None) -> DataFrame:
    """Rows by reason; each row of ``failures``, a document that could not be read, counts as a source failure."""
    reasons = decided.select(*by, "reason")
    if failures is not None:
        reasons = reasons.unionByName(failures.select(*by, F.lit("source_failure").alias("reason")))
    return reasons.groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("records"))


def with_landed(rows: DataFrame, documents: DataFrame, by: str) -> DataFrame:
    """The rows marked ``landed`` false, and one row marked true per landed document that has only its source.

    So one grouping counts both: a source whose documents hold nothing still has a row, and no
    document is read for more than its source.
    """
    return rows.withColumn("landed", F.lit(False)).unionByName(
        documents.select(by, F.lit(True).alias("landed")), allowMissingColumns=True
    )


def gate_summary(decided: DataFrame, by: str, documents: DataFrame | None = None) -> DataFrame:
    """Counters per source and, with a null source, over all of them.

    ``decided`` has a status and whether an accepted row won its duplicate check. With the landed
    ``documents`` there is also ``discovered``, how many of them a source has.
    """
    accepted = F.col("status") == "ACCEPT"
    counted = [
        F.count("status").alias("parsed"),
        F.count_if(accepted & F.col("claimed")).alias("accepted"),
        F.count_if(F.col("status") == "REJECT").alias("rejected"),
        F.count_if(F.col("status") == "QUARANTINE").alias("quarantined"),
        F.count_if(accepted & ~F.col("claimed")).alias("duplicates"),
    ]
    if documents is None:
        return decided.rollup(by).agg(*counted)
    rows = with_landed(decided.select(by, "status", "claimed"), documents, by)
    return rows.rollup(by).agg(F.count_if("landed").alias("discovered"), *counted)


def reason_map(decided: DataFrame, by: str, failures: DataFrame | None = None) -> DataFrame:
    """One map of reason to count per source."""
    counts = reason_counts(decided, [by], failures)
    entries = F.collect_list(F.struct("reason", "records"))
    return counts.groupBy(by).agg(F.map_from_entries(F.array_sort(entries)).alias("reasons"))


def advance_watermarks(stored: DataFrame | None, accepted: DataFrame, source: str, published_at: str) -> DataFrame:
    """Latest publication time per source; it never moves backwards."""
    latest = accepted.groupBy(source).agg(F.max(published_at).alias("watermark"))
    if stored is None:
        return latest
    both = stored.select(source, "watermark").unionByName(latest)
    return both.groupBy(source).agg(F.max("watermark").alias("watermark"))


def since_watermark(rows: DataFrame, watermarks: DataFrame, source: str, published_at: str) -> DataFrame:
    """Rows newer than their source's watermark; sources without one pass whole."""
    marked = lookup_join(rows, watermarks.select(source, "watermark"), [source], "left", spread=F.col(published_at))
    return marked.filter(F.col("watermark").isNull() | (F.col(published_at) > F.col("watermark"))).drop("watermark")
