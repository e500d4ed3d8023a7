"""A corpus pipeline: quality rules, near-duplicates, benchmark leaks, personal data, packing.

Each stage takes what its predecessor kept, and all but the last return its columns. Rows that
share a doc_id count as one document and stay or go together; rows without one count as one
document too, which has no near-duplicates. Null texts are empty and don't pass the quality
rules. Empty tables pass every stage as empty tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.llm.bagminhash import near_classes
from lodegate.llm.context import materialize, prepare, table
from lodegate.llm.leaks import find_leaks
from lodegate.llm.packing import pack
from lodegate.llm.pseudonyms import masked, session_key
from lodegate.llm.quality import keep_good
from lodegate.session import Scratch, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_scratch = Scratch()


def stage(run: Stage) -> Stage:
    """Removes the scratch tables of the stage before, whose rows are written when the next one begins."""

    @wraps(run)
    def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _scratch.remove(spark)
        with _scratch:
            return run(prepare(spark), docs, sf_dir)

    return clean


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not the only column of ``ids``; null is an id here.

    The ids are those to drop, few beside the rows. Written first, so that Spark knows their size
    and moves the rows only if they are too many to send.
    """
    name = "dropped"
    while name in docs.columns:
        name += "_"
    dropped = materialize(ids.toDF(name).distinct(), "dropped")
    return docs.join(dropped, docs["doc_id"].eqNullSafe(dropped[name]), "left_anti")


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return keep_good(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class."""
    return _without(docs, near_classes(docs).filter("doc_id <> class_id").select("doc_id"))


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor an edited copy of one."""
    return _without(docs, find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))


@stage
def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with pseudonyms for personal data, and their length with them."""
    hidden = docs.withColumn("text", masked(F.col("text"), session_key(spark)))
    if "n_chars" not in docs.columns:
        return hidden
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 1024 tokens."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private_data", private_data),
    ("packing", packing),
]

# Posteriors, signatures, alignments, ciphers and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex[:8]}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
