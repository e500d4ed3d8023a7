"""Lookups that complete candidates: bibliography, repositories, articles, extractions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodegate.functions.binding import stage
from lodegate.functions.directory import PRICING_MODELS
from lodegate.functions.identity import repository_url
from lodegate.functions.markup import article_author, article_body, article_date, article_pieces
from lodegate.functions.text import casefold, is_remote, role_family
from lodegate.scale import lookup_join, parallel
from lodegate.session import materialize


def hydrate(candidates: DataFrame, papers: DataFrame, order: str) -> DataFrame:
    """Complete papers without a date from their bibliographic record.

    ``papers`` has arxiv_id, paper_url, title, authors, published_at and
    abstract, any number of rows per id, and where known the raw_document_id and
    original_url it was read from. Adds ``reject_reason``: an id must be present,
    name exactly one record, and that record must be the same paper. Adds the
    evidence of completed papers (bibliographic_*), null for others.
    """
    fields = ("title", "authors", "published_at", "abstract")
    known = [name for name in ("raw_document_id", "original_url") if name in papers.columns]
    single = papers.groupBy("arxiv_id").agg(
        F.count(F.lit(1)).alias("_found"),
        F.min_by(F.struct("paper_url", *fields, *known), "paper_url").alias("_paper"),
    )
    joined = lookup_join(candidates, single, ["arxiv_id"], "left", spread=F.col(order))
    needed = F.col("published_at").isNull()
    reason = F.when(
        needed,
        F.when(F.coalesce("arxiv_id", F.lit("")) == "", "missing_arxiv_id")
        .when(F.col("_found").isNull(), "metadata_missing")
        .when(F.col("_found") != 1, "metadata_ambiguous")
        .when(F.col("_paper.paper_url") != F.col("paper_url"), "metadata_mismatch"),
    )
    take = needed & reason.isNull()
    hydrated = {name: F.when(take, F.col(f"_paper.{name}")).otherwise(F.col(name)) for name in fields}
    evidence = lambda name: F.when(take, F.col(f"_paper.{name}")) if name in known else F.lit(None).cast("string")
    told = {
        "bibliographic_parser": F.when(take, "arxiv_atom_v1"),
        "bibliographic_source_url": evidence("original_url"),
        "bibliographic_raw_document_id": evidence("raw_document_id"),
    }
    return joined.withColumns({**hydrated, **told, "reject_reason": reason}).drop("_found", "_paper")


def repository_addresses(candidates: DataFrame) -> DataFrame:
    """Candidates with the normalized_url of their code, null where the link is no repository."""
    return stage(parallel(candidates), {"normalized_url": repository_url(F.col("github_url"))})


def add_repository(
    candidates: DataFrame, repositories: DataFrame, order: str, *, addressed: DataFrame | None = None
) -> DataFrame:
    """Attach verified repository names and stars by normalized address.

    ``repositories`` has normalized_url, full_name and stars, one row per
    address, and where known the raw_document_id and retrieved_at of its response,
    which become github_api_raw_document_id and github_api_retrieved_at. A candidate
    without a link passes; a link that is no repository or has no usable metadata rejects.
    ``addressed``, where given, is the table from which the candidates have their normalized_url.
    """
    told = {
        f"github_api_{name}": (F.col(name) if name in repositories.columns else F.lit(None)).cast(kind).alias(f"github_api_{name}")
        for name, kind in (("raw_document_id", "string"), ("retrieved_at", "timestamp"))
    }
    usable = repositories.filter((F.col("stars") >= 0) & (F.coalesce("full_name", F.lit("")) != ""))
    keyed = repository_addresses(candidates) if addressed is None else candidates
    found = usable.select("normalized_url", "full_name", "stars", *told.values())
    joined = lookup_join(keyed, found, ["normalized_url"], "left", spread=F.col(order), counted=addressed)
    linked = F.col("github_url").isNotNull()
    reason = F.when(linked & F.col("normalized_url").isNull(), "not_a_repository").when(
        linked & F.col("stars").isNull(), "repository_unverified"
    )
    known = F.col("reject_reason") if "reject_reason" in candidates.columns else F.lit(None).cast("string")
    return joined.withColumns(
        {"github_url": F.coalesce("normalized_url", "github_url"), "reject_reason": F.coalesce(known, reason)}
    ).drop("normalized_url")


def needed_lookups(candidates: DataFrame) -> DataFrame:
    """Distinct repository addresses to look up, each one once."""
    return candidates.select(repository_url(F.col("github_url")).alias("normalized_url")).na.drop().distinct()


def read_articles(pages: DataFrame, html: str, fallback: Column, now: Column) -> DataFrame:
    """Add article_title, article_body, article_author and article_date to pages."""
    read = stage(parallel(pages), {"_pieces": article_pieces(F.col(html))})
    read = stage(read, {"article_body": article_body(F.col("_pieces"), fallback)})
    return stage(
        read,
        {
            "article_title": F.col("_pieces.title"),
            "article_author": article_author(F.col("_pieces")),
            "article_date": article_date(F.col("_pieces"), F.col("article_body"), now),
        },
    ).drop("_pieces")


# Columns by which a record names the raw document it was made from.
RAW_EVIDENCE = ("raw_document_id", "content_hash", "retrieved_at")


def _one_per_address(pages: DataFrame) -> DataFrame:
    """One page per address: the earliest where that is known, then the one whose content has the least hash.

    Addresses that occur once, nearly all, are found by a narrow count and their bodies are not moved.
    """
    counted = pages.groupBy("original_url").agg(F.count(F.lit(1)).alias("_pages"))
    repeated = materialize(counted.filter(F.col("_pages") > 1).select("original_url"), "repeated-addresses")
    if repeated.isEmpty():
        return pages
    place = F.col("retrieved_at") if "retrieved_at" in pages.columns else F.lit(0)
    landed = pages.withColumn("_place", F.struct(place, F.sha2("html", 256), F.monotonically_increasing_id()))
    single = lookup_join(landed, repeated, ["original_url"], "left_anti", spread=F.col("_place"))
    several = lookup_join(landed, repeated, ["original_url"], "left_semi", spread=F.col("_place"))
    others = [name for name in pages.columns if name != "original_url"]
    first = several.groupBy("original_url").agg(F.min_by(F.struct(*others), "_place").alias("_page"))
    return single.select(*pages.columns).unionByName(first.select("original_url", "_page.*"))


def _join_articles(candidates: DataFrame, pages: DataFrame, body: str, order: str, now: Column) -> DataFrame:
    """Candidates with their article; ``pages`` has original_url and html. Of several pages of an address one counts.

    Where ``pages`` has raw document columns too, a candidate with an article takes them over,
    as its facts then come from that document.
    """
    raw = [name for name in RAW_EVIDENCE if name in pages.columns and name in candidates.columns]
    landed = _one_per_address(pages).select("original_url", "html", *[F.col(name).alias(f"_landed_{name}") for name in raw])
    joined = lookup_join(candidates, landed, ["original_url"], "left", spread=F.col(order))
    taken = {name: F.coalesce(F.col(f"_landed_{name}"), F.col(name)) for name in raw}
    return read_articles(joined.withColumns(taken), "html", F.col(body), now)


def _from_article(has: Column, body: str) -> dict[str, Column]:
    at = F.col("article_date")
    longer = F.length("article_body") >= F.length(body)
    filled = lambda new, old: F.coalesce(F.nullif(new, F.lit("")), old)
    return {
        "title": F.when(has, filled(F.col("article_title"), F.col("title"))).otherwise(F.col("title")),
        body: F.when(has & longer, F.col("article_body")).otherwise(F.col(body)),
        "published_at": F.when(has, F.coalesce(at["published_at"], "published_at")).otherwise(F.col("published_at")),
        "date_source": F.when(has, F.coalesce(at["source"], "date_source")).otherwise(F.col("date_source")),
        "date_confidence": F.when(has, F.greatest(at["confidence"], "date_confidence")).otherwise(F.col("date_confidence")),
    }


def enrich_news(candidates: DataFrame, pages: DataFrame, order: str, now: Column) -> DataFrame:
    """Replace feed facts by better ones of the landed article; no page, no change."""
    joined = _join_articles(candidates, pages, "body", order, now)
    has = F.col("html").isNotNull()
    author = F.when(has, F.coalesce(F.nullif(F.col("article_author"), F.lit("")), "author")).otherwise(F.col("author"))
    return joined.withColumns({**_from_article(has, "body"), "author": author}).select(*candidates.columns)


def enrich_jobs(candidates: DataFrame, pages: DataFrame, order: str, now: Column) -> DataFrame:
    joined = _join_articles(candidates, pages, "description", order, now)
    has = F.col("html").isNotNull()
    joined = stage(joined, {"_words": casefold(F.concat_ws(" ", "title", "article_body"))})
    words = F.col("_words")
    changes = {
        **_from_article(has, "description"),
        "is_remote": F.col("is_remote") | (has & is_remote(words)),
        "role_family": F.coalesce("role_family", F.when(has, role_family(words))),
    }
    return joined.withColumns(changes).select(*candidates.columns)


# Landed model extractions fold into candidates; a candidate without one is unchanged.


def fold_job(candidates: DataFrame, extracted: DataFrame, key: str, order: str) -> DataFrame:
    found = extracted.select(key, *[F.col(c).alias(f"x_{c}") for c in ("company", "is_remote", "role_family")])
    joined = lookup_join(candidates, found, [key], "left", spread=F.col(order))
    return joined.withColumns(
        {
            "company": F.coalesce(F.nullif("x_company", F.lit("")), "company"),
            "is_remote": F.coalesce("x_is_remote", F.lit(False)) | F.col("is_remote"),
            "role_family": F.coalesce(F.nullif("x_role_family", F.lit("")), "role_family"),
        }
    ).select(*candidates.columns)


def fold_news(candidates: DataFrame, extracted: DataFrame, key: str, order: str) -> DataFrame:
    found = extracted.select(key, F.col("category").alias("x_category"))
    joined = lookup_join(candidates, found, [key], "left", spread=F.col(order))
    return joined.withColumn("category", F.coalesce(F.nullif("x_category", F.lit("")), "category")).select(*candidates.columns)


def fold_startup(candidates: DataFrame, extracted: DataFrame, key: str, order: str) -> DataFrame:
    """Fill only what the source left open."""
    fields = ("employee_count", "headquarters", "founded_year")
    found = extracted.select(key, F.lit(True).alias("x_used"), *[F.col(c).alias(f"x_{c}") for c in fields])
    joined = lookup_join(candidates, found, [key], "left", spread=F.col(order))
    filled = {c: F.coalesce(c, f"x_{c}") for c in fields}
    return joined.withColumns({**filled, "model_used": F.coalesce("x_used", F.lit(False))}).select(
        *candidates.columns, "model_used"
    )


def fold_product(candidates: DataFrame, extracted: DataFrame, key: str, order: str) -> DataFrame:
    """Name the maker when unknown; take the pricing model when it is a valid one."""
    found = extracted.select(
        key, F.lit(True).alias("x_used"), F.col("startup_name").alias("x_name"), F.col("pricing_model").alias("x_pricing")
    )
    joined = lookup_join(candidates, found, [key], "left", spread=F.col(order))
    unknown = F.coalesce("startup_name", F.lit("")).isin("Unknown", "")
    named = F.coalesce("x_name", F.lit("")) != ""
    return joined.withColumns(
        {
            "startup_name": F.when(unknown & named, F.col("x_name")).otherwise(F.col("startup_name")),
            "pricing_model": F.when(F.col("x_pricing").isin(*PRICING_MODELS), F.col("x_pricing")).otherwise(F.col("pricing_model")),
            "model_used": F.coalesce("x_used", F.lit(False)),
        }
    ).select(*candidates.columns, "model_used")
