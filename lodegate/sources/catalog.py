"""Source configuration: the fixed source list, YAML files and settings."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

CATALOG_SCHEMA = (
    "id string, name string, record_type string, mode string, enabled boolean, endpoint string, listing_url string, "
    "feed_url string, batch_size long, page_size long, max_records long"
)
DEFAULT_PAGE_SIZE = 100
DEFAULT_MAX_RECORDS = 1000

# The feeds with an adapter of their own.
NEWS_FEEDS = {
    "techcrunch_ai": ("TechCrunch AI", "https://techcrunch.com/category/artificial-intelligence/feed/"),
    "venturebeat_ai": ("VentureBeat AI", "https://venturebeat.com/category/ai/feed/"),
    "mit_technology_review_ai": (
        "MIT Technology Review AI", "https://www.technologyreview.com/topic/artificial-intelligence/feed/"
    ),
    "openai_news": ("OpenAI News", "https://openai.com/news/rss.xml"),
    "google_ai_blog": ("Google AI Blog", "https://blog.google/technology/ai/rss/"),
}
JOB_FEEDS = {
    "remoteok_ai": ("Remote OK AI Jobs", "https://remoteok.com/remote-ai-jobs.rss"),
    "wework_remotely_ai": (
        "We Work Remotely Programming Jobs", "https://weworkremotely.com/categories/remote-programming-jobs.rss"
    ),
    "ai_jobs": ("AI Jobs", "https://ai-jobs.net/rss/"),
    "greenhouse_ai": ("Greenhouse AI Jobs", "https://job-boards.greenhouse.io/rss"),
    "lever_ai": ("Lever AI Jobs", "https://jobs.lever.co/rss"),
}


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Sources of a YAML file with a ``sources`` list."""
    import yaml

    entries = (yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}).get("sources", [])
    names = [part.split()[0] for part in CATALOG_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(entry.get(name) for name in names) for entry in entries], CATALOG_SCHEMA)


def feed_sources(catalog: DataFrame, record_type: str) -> DataFrame:
    """Enabled sources of a record type that have a feed."""
    wanted = (F.col("record_type") == record_type) & F.coalesce("enabled", F.lit(False)) & (F.coalesce("feed_url", F.lit("")) != "")
    return catalog.filter(wanted).select("id", "name", "feed_url")


def directory_sources(catalog: DataFrame, record_type: str) -> DataFrame:
    """Enabled sources of a record type that have a listing, with default sizes."""
    wanted = (F.col("record_type") == record_type) & F.coalesce("enabled", F.lit(False)) & (F.coalesce("listing_url", F.lit("")) != "")
    return catalog.filter(wanted).select(
        "id",
        "name",
        "listing_url",
        F.coalesce("page_size", F.lit(DEFAULT_PAGE_SIZE)).alias("page_size"),
        F.coalesce("max_records", F.lit(DEFAULT_MAX_RECORDS)).alias("max_records"),
    )


def source(catalog: DataFrame, source_id: str) -> dict:
    """Settings of one named source."""
    rows = catalog.filter(F.col("id") == source_id).take(1)
    if not rows:
        raise ValueError(f"The catalog does not define source {source_id!r}")
    return rows[0].asDict()


@dataclass(frozen=True)
class Settings:
    """Engine settings; environment variables with the prefix override them."""

    raw_root: str = "data/raw"
    tables_root: str = "data/tables"
    max_attempts: int = 3
    retry_base_seconds: float = 0.5
    retry_cap_seconds: float = 8.0
    rate_per_second: float = 5.0
    burst: int = 10
    chunk_target_tokens: int = 5000
    breaker_threshold: int = 5
    breaker_cooldown_seconds: float = 60.0
    providers: tuple[str, ...] = field(default=("gemini", "groq", "deepseek"))

    @classmethod
    def load(cls, path: str | None = None, prefix: str = "LODEGATE_") -> Settings:
        import yaml

        values = (yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}) if path else {}
        settings = replace(cls(), **{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})
        for name, current in vars(settings).items():
            given = os.environ.get(prefix + name.upper())
            if given is not None:
                value = tuple(given.split(",")) if isinstance(current, tuple) else type(current)(given)
                settings = replace(settings, **{name: value})
        return settings
