"""Registry of queries and helpers to derive their inputs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lodegate.session import tune

Runner = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@dataclass(frozen=True)
class Query:
    run: Runner
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derive(spark: SparkSession, folder: str, sql: str, **frames: DataFrame) -> DataFrame:
    """Run an input statement; {name} stands for a given table or a frame."""
    used = {name: table(spark, folder, name) for name in TABLES if "{" + name + "}" in sql}
    return spark.sql(sql, **used, **frames)


def plain(sql: str) -> str:
    """The same input statement with table names, for the reference SQL."""
    return sql.format(**{name: name for name in TABLES})


def query(oracle: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query under its function name."""

    def add(run: Runner) -> Runner:
        def tuned(spark: SparkSession, folder: str) -> DataFrame:
            return run(tune(spark), folder)

        if run.__name__ in REGISTRY:
            raise ValueError(f"Query {run.__name__} is already registered")
        REGISTRY[run.__name__] = Query(tuned, oracle)
        return run

    return add
