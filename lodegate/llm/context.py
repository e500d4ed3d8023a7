"""Session settings, input checks and shared scratch tables for these operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.session import materialize, tune

# Python workers hold a few batches at once, so a batch is bounded by rows and by bytes.
_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
}


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    for key, value in _BATCHES.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(df: DataFrame, key: str, text: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """The id and the text alone, null texts as empty; other columns can't clash with ours."""
    new_key, new_text = (names or {}).get("key", "doc_id"), (names or {}).get("text", "text")
    return df.select(
        F.col(f"`{key}`").cast("long").alias(new_key),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(new_text),
    )


__all__ = ["materialize", "prepare", "table", "texts"]
