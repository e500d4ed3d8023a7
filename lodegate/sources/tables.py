"""Readers of landed files and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegate.functions.binding import json_value
from lodegate.functions.text import entity_slug
from lodegate.operators.export import LOG_ORDER, TAB_TABLES
from lodegate.operators.storage import read_table

# Names of the starter set of entities.
STARTER_NAMES = (
    "Anthropic", "OpenAI", "Cohere", "Hugging Face", "Mistral AI", "Perplexity", "Scale AI", "Databricks", "xAI", "Runway",
    "Adept", "Character.AI", "Inflection AI", "Stability AI", "Midjourney", "ElevenLabs", "Replit", "Cursor", "Harvey", "Glean",
    "Pika", "Synthesia", "Weights & Biases", "Together AI", "Anyscale", "LangChain", "Modal", "Replicate", "Vercel", "Pinecone",
    "Weaviate", "Chroma", "LlamaIndex", "Jasper", "Copy.ai", "Writer", "Sierra", "Hebbia", "Contextual AI", "Imbue",
    "Poolside", "Abridge", "Hippocratic AI", "Nabla", "Tempus", "Insilico Medicine", "Wayve", "Covariant",
    "Physical Intelligence", "Figure AI",
)


def landed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Landed response bodies: path, modification time, length and bytes."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)


def read_body(raw: DataFrame, storage_key: str) -> DataFrame:
    """Bytes of one stored document."""
    return raw.filter(F.col("storage_key") == storage_key).select("storage_key", "body")


def json_lines(spark: SparkSession, path: str, schema, *, strict: bool) -> DataFrame:
    """JSON lines; broken lines are skipped, or fail the read when ``strict``."""
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    return spark.read.schema(schema).option("mode", mode).json(path)


def seed_file(spark: SparkSession, path: str) -> DataFrame:
    """Entity seeds of a JSON list; items without text id and name are skipped."""
    text = spark.read.text(path, wholetext=True)
    items = F.try_variant_get(json_value(F.col("value")), "$", "array<variant>")
    checked = F.coalesce(items, F.raise_error("Entity seed file must contain a list").cast("array<variant>"))
    rows = text.select(F.explode(checked).alias("item"))

    def typed(field):
        value = F.try_variant_get("item", f"$.{field}", "variant")
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))

    aliases = F.filter(
        F.try_variant_get("item", "$.aliases", "array<variant>"), lambda v: F.schema_of_variant(v) == "STRING"
    )
    return rows.select(
        typed("canonicalEntityId").alias("entity_id"),
        typed("rawEntityName").alias("canonical_name"),
        F.coalesce(F.transform(aliases, lambda v: F.try_variant_get(v, "$", "string")), F.array().cast("array<string>")).alias("aliases"),
    ).na.drop(subset=["entity_id", "canonical_name"])


def starter_seeds(spark: SparkSession) -> DataFrame:
    names = spark.createDataFrame([(name,) for name in STARTER_NAMES], "canonical_name string")
    return names.select(
        F.concat(F.lit("startup:"), entity_slug(F.col("canonical_name"))).alias("entity_id"),
        "canonical_name",
        F.array().cast("array<string>").alias("aliases"),
    )


def read_tabs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Stored tables behind the export tabs; absent tables are left out.

    Records are their id and payload in the order of the id, the mapping log its own columns in the
    order in which its rows were appended, or of their time where that is not stored.
    """
    tabs = {}
    for tab, name in TAB_TABLES.items():
        stored = read_table(spark, f"{root.rstrip('/')}/{name}")
        if stored is None:
            continue
        if name == "entity_mapping_log":
            placed = [column for column in LOG_ORDER if column in stored.columns]
            tabs[tab] = stored.orderBy(*(placed or ["createdAt"]))
        elif "payload" in stored.columns:
            tabs[tab] = stored.select("record_id", "payload").orderBy("record_id")
        else:
            tabs[tab] = stored.orderBy("record_id")
    return tabs
