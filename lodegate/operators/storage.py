"""Raw evidence, insert-only record tables and their integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodegate.functions.binding import stage
from lodegate.functions.identity import canonical_url, content_hash, raw_document_id, storage_key
from lodegate.operators.freshness import with_landed
from lodegate.scale import lookup_join
from lodegate.session import materialize

RAW_PARTITIONS = ("source_id", "year", "month", "day")


def raw_documents(responses: DataFrame) -> DataFrame:
    """Evidence rows of responses with source_id, request_url, response_url, status_code,
    headers (map), body (binary) and retrieved_at; addresses that are not http(s) drop out."""
    typed = F.try_element_at("headers", F.lit("content-type"))
    keyed = stage(
        responses,
        {"canonical_url": canonical_url(F.col("response_url")), "content_hash": content_hash(F.col("body")), "content_type": typed},
        keep=lambda r: r["canonical_url"].isNotNull(),
    )
    source = F.col("source_id")
    return keyed.select(
        raw_document_id(source, F.col("canonical_url"), F.col("content_hash")).alias("raw_document_id"),
        "source_id",
        F.col("request_url").alias("original_url"),
        "canonical_url",
        "content_hash",
        "retrieved_at",
        "status_code",
        "headers",
        storage_key(source, F.col("retrieved_at"), F.col("content_hash"), F.col("content_type")).alias("storage_key"),
        "content_type",
        "body",
    )


def write_raw(documents: DataFrame, path: str) -> None:
    """Append evidence not stored yet, one folder per source and day; rows without an id stay out.

    The earliest row of an id is written, of several at one time the least by all that is known of it,
    so a repeat picks the same. Rows are numbered in a table; which to write is found without bodies.
    """
    spark = documents.sparkSession
    number = "row"
    while number in documents.columns:
        number += "_"
    rows = materialize(documents.filter(F.col("raw_document_id").isNotNull()).withColumn(number, F.monotonically_increasing_id()), "raw")
    known = F.struct("retrieved_at", *_known(documents.columns), _heads().alias("heads"), number)
    first = rows.groupBy("raw_document_id").agg(F.min(known)[number].alias(number))
    stored = read_table(spark, path)
    if stored is not None:
        first = lookup_join(first, stored.select("raw_document_id").distinct(), ["raw_document_id"], "left_anti", spread=F.col(number))
    at = F.col("retrieved_at")
    rows.join(first.select(number), [number], "left_semi").drop(number).withColumns(
        {"year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd")}
    ).write.mode("append").partitionBy(*RAW_PARTITIONS).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet table, or None when nothing was written there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if files.exists(folder) else None


def inserted_flags(incoming: DataFrame, stored: DataFrame | None, key: str, order: str) -> DataFrame:
    """Add ``inserted``: the first row of a key that the table does not hold yet.

    First write wins and nothing is updated. Only one narrow row per key meets
    the stored keys; the flag comes back over the unique order column. That join is a
    merge: rows made from narrower input look small to the planner, which would broadcast them.
    """
    fresh = incoming.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(order))
    if stored is not None:
        fresh = lookup_join(fresh, stored.select(key), [key], "left_anti", spread=F.col(order))
    flags = fresh.select(order, F.lit(True).alias("inserted"))
    return incoming.join(flags.hint("merge"), [order], "left").withColumn("inserted", F.coalesce("inserted", F.lit(False)))


def insert_new(incoming: DataFrame, path: str, key: str, order: str) -> DataFrame:
    """Append the new rows to a table and return every row with its flag.

    Running it again with the same rows inserts nothing, so a failed job can be
    repeated. One writer per table at a time.
    """
    flagged = materialize(inserted_flags(incoming, read_table(incoming.sparkSession, path), key, order), "insert")
    flagged.filter("inserted").drop("inserted").write.mode("append").parquet(path)
    return flagged


def write_batch(rows: DataFrame, path: str, batch: int, key: str, order: str | None = None) -> None:
    """Write a batch's new rows under a folder of its own, so that a repeated batch replaces itself.

    Keys of earlier batches and later rows of a key stay out; ``order`` is unique in ``rows``, or
    not given where the key itself is. A repeat with the same rows leaves the same table, whether the first attempt ended or not. A
    batch without new rows writes nothing.
    """
    stored = read_table(rows.sparkSession, path)
    earlier = None if stored is None else stored.filter(F.col("batch") < batch)
    if order is not None:
        fresh = inserted_flags(rows, earlier, key, order).filter("inserted").drop("inserted")
    else:
        keyed = rows.filter(F.col(key).isNotNull())
        fresh = keyed if earlier is None else lookup_join(keyed, earlier.select(key), [key], "left_anti", spread=F.col(key))
    keyed = fresh.withColumn("batch", F.lit(batch).cast("long"))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def _known(columns: list[str]) -> list[str]:
    return [c for c in columns if c not in ("raw_document_id", "retrieved_at", "headers", "body")]


def _heads() -> Column:
    """The headers as a sorted list, as maps have no order."""
    return F.array_sort(F.map_entries("headers"))


def first_responses(responses: DataFrame) -> DataFrame:
    """The earliest response of each raw document, without its body; ties by all that is known of it."""
    known = F.struct("retrieved_at", *_known(responses.columns), _heads().alias("heads"))
    first = responses.filter(F.col("raw_document_id").isNotNull()).groupBy("raw_document_id").agg(F.min(known).alias("first"))
    return first.select("raw_document_id", "first.*").withColumn("headers", F.map_from_entries("heads")).drop("heads")


def append_lines(rows: DataFrame, path: str) -> None:
    """Append rows to a folder of JSON lines, nulls written out."""
    rows.write.mode("append").option("ignoreNullFields", False).json(path)


def latest_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Last write wins: the row with the largest order per key."""
    last = rows.groupBy(key).agg(F.max(order).alias(order)).select(order)
    return rows.join(last, [order], "left_semi")


def missing_references(rows: DataFrame, column: str, documents: DataFrame, key: str, spread: Column) -> DataFrame:
    """Rows whose reference points to no stored document; must be empty."""
    known = documents.select(F.col(key).alias(column)).distinct()
    return lookup_join(rows, known, [column], "left_anti", spread=spread)


def insert_counts(flagged: DataFrame, by: str, documents: DataFrame | None = None) -> DataFrame:
    """Parsed, inserted, duplicate and rejected records per source and in total.

    With the landed ``documents`` there is also ``discovered``, how many of them a source has.
    """
    rejected = F.col("reject_reason").isNotNull()
    counted = [
        F.count("inserted").alias("parsed"),
        F.count_if(~rejected & F.col("inserted")).alias("inserted"),
        F.count_if(~rejected & ~F.col("inserted")).alias("duplicates"),
        F.count_if(rejected).alias("rejected"),
    ]
    if documents is None:
        return flagged.rollup(by).agg(*counted)
    rows = with_landed(flagged.select(by, "reject_reason", "inserted"), documents, by)
    return rows.rollup(by).agg(F.count_if("landed").alias("discovered"), *counted)
