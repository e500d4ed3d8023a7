"""Entity resolution: alias tables, exact and fuzzy matching, mapping log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodegate.functions.binding import stage
from lodegate.functions.text import entity_key, strip
from lodegate.operators.matching import best_matches
from lodegate.scale import lookup_join
from lodegate.session import materialize

# Scores from which a match is certain or needs a review.
AUTO_THRESHOLD = 0.95
REVIEW_THRESHOLD = 0.80


def alias_keys(seeds: DataFrame) -> DataFrame:
    """(entity_key, entity_id) of every canonical name and alias with a non-empty key.

    ``seeds`` has entity_id, canonical_name and an aliases array.
    """
    names = F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return (
        stage(
            seeds.select("entity_id", F.explode(names).alias("name")),
            {"entity_key": entity_key(F.col("name"))},
            keep=lambda r: r["entity_key"] != "",
        )
        .select("entity_key", "entity_id")
        .distinct()
    )


def alias_index(seeds: DataFrame) -> DataFrame:
    """(entity_key, entity_id) with each key once; of several entities that claim a key, the larger id, as for ties of a score."""
    return alias_keys(seeds).groupBy("entity_key").agg(F.max("entity_id").alias("entity_id"))


def alias_conflicts(seeds: DataFrame) -> DataFrame:
    """Keys claimed by more than one entity; an alias table must have none."""
    return (
        alias_keys(seeds)
        .groupBy("entity_key")
        .agg(F.count(F.lit(1)).alias("entities"), F.min("entity_id").alias("first_entity"), F.max("entity_id").alias("last_entity"))
        .filter(F.col("entities") > 1)
    )


def check_seeds(seeds: DataFrame) -> DataFrame:
    """The seeds, failing on a missing id or name and on an ambiguous alias."""
    unusable = (F.coalesce("entity_id", F.lit("")) == "") | (strip(F.coalesce("canonical_name", F.lit(""))) == "")
    if not seeds.filter(unusable).isEmpty():
        raise ValueError("Every seed needs an entity_id and a canonical_name")
    if not alias_conflicts(seeds).isEmpty():
        raise ValueError("An alias maps to more than one entity")
    return seeds


def match_status(confidence: Column, auto: float = AUTO_THRESHOLD, review: float = REVIEW_THRESHOLD) -> Column:
    if not 0 <= review <= auto <= 1:
        raise ValueError("thresholds must satisfy 0 <= review <= auto <= 1")
    return F.when(confidence >= auto, "AUTO_MATCH").when(confidence >= review, "REVIEW").otherwise("UNRESOLVED")


def best_seeds(names: DataFrame, seeds: DataFrame) -> DataFrame:
    """Best match of distinct name_key values among the canonical names of ``seeds``."""
    return best_matches(names, seeds.select("entity_id", entity_key(F.col("canonical_name")).alias("seed_key")))


def resolve_names(
    names: DataFrame, seeds: DataFrame, *, auto: float = AUTO_THRESHOLD, review: float = REVIEW_THRESHOLD
) -> DataFrame:
    """Resolve distinct ``raw_name`` values against seeds.

    Adds canonical_name, canonical_entity_id, method, confidence and status.
    Names equal to an alias key match exactly; only the keys left over are scored. A name that
    several seeds claim has one row still (``alias_index``); ``check_seeds`` refuses such seeds.
    """
    keyed = stage(names.select("raw_name"), {"name_key": entity_key(F.col("raw_name"))})
    aliases = alias_index(seeds).select(F.col("entity_key").alias("name_key"), "entity_id")
    exact = materialize(lookup_join(keyed, aliases, ["name_key"], "left", spread=F.col("raw_name")), "exact-matches")
    blank = strip(F.col("raw_name")) == ""
    open_keys = exact.filter(F.col("entity_id").isNull() & ~blank).select("name_key").distinct()
    fuzzy = best_seeds(open_keys, seeds)
    scored = lookup_join(
        exact, fuzzy.withColumnRenamed("entity_id", "fuzzy_id"), ["name_key"], "left", spread=F.col("raw_name")
    )
    found = (F.col("method") != "unresolved")
    decided = scored.select(
        "raw_name",
        F.coalesce("entity_id", F.when(~blank, F.col("fuzzy_id"))).alias("entity_id"),
        F.when(F.col("entity_id").isNotNull(), F.lit(1.0))
        .when(blank, F.lit(0.0))
        .otherwise(F.coalesce("confidence", F.lit(0.0)))
        .alias("confidence"),
        F.col("entity_id").isNotNull().alias("is_exact"),
    ).withColumn("status", F.when(F.col("is_exact"), "AUTO_MATCH").otherwise(match_status(F.col("confidence"), auto, review)))
    labelled = decided.withColumn(
        "method",
        F.when(F.col("is_exact"), "exact").when(F.col("status") == "UNRESOLVED", "unresolved").otherwise("fuzzy"),
    )
    titled = lookup_join(labelled, seeds.select("entity_id", "canonical_name"), ["entity_id"], "left", spread=F.col("raw_name"))
    return titled.select(
        "raw_name",
        F.when(found, F.col("canonical_name")).alias("canonical_name"),
        F.when(found, F.col("entity_id")).alias("canonical_entity_id"),
        "method",
        "confidence",
        "status",
    )


def resolve(mentions: DataFrame, name: str, seeds: DataFrame, *, spread: Column, **thresholds: float) -> DataFrame:
    """Mentions with the resolution of their name; each distinct name is matched once."""
    names = mentions.select(F.col(name).alias("raw_name")).filter(F.col("raw_name").isNotNull()).distinct()
    resolved = materialize(resolve_names(names, seeds, **thresholds), "resolved-names")
    return lookup_join(mentions, resolved.withColumnRenamed("raw_name", name), [name], "left", spread=spread)


def resolved_name(raw: Column, canonical: Column, status: Column) -> Column:
    """The canonical name only when the match is certain."""
    return F.when((status == "AUTO_MATCH") & (F.coalesce(canonical, F.lit("")) != ""), canonical).otherwise(raw)


def mapping_rows(
    resolved: DataFrame, name: str, source: Column, record_id: Column, at: Column, mapping_id: Column | None = None
) -> DataFrame:
    """Append-only log rows of how names were mapped, with the place of a row in its batch where that is given."""
    numbered = [] if mapping_id is None else [mapping_id.alias("mappingId")]
    return resolved.select(
        F.col(name).alias("rawName"),
        F.col("canonical_name").alias("canonicalName"),
        source.alias("source"),
        "method",
        "confidence",
        "status",
        record_id.alias("recordId"),
        at.alias("createdAt"),
        *numbered,
    )


def latest_mappings(log: DataFrame, order: str) -> DataFrame:
    """Last mapping written per raw name and source."""
    others = [c for c in log.columns if c not in ("rawName", "source", order)]
    last = log.groupBy("rawName", "source").agg(F.max(F.struct(order, *others)).alias("_last"))
    return last.select("rawName", "source", "_last.*")
