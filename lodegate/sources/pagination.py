"""Addresses of the pages of a listing, one row per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodegate.functions.identity import with_page


def _explode_range(listings: DataFrame, stop: Column, step: Column, name: str) -> DataFrame:
    last = F.floor((stop - 1) / step) * step
    return listings.withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"), step.cast("bigint"))))


def offset_pages(listings: DataFrame, template: str, batch_size: str, max_records: str) -> DataFrame:
    """{offset} and {length} filled; the last page is trimmed to the record limit."""
    batch, limit = F.col(batch_size), F.col(max_records)
    pages = _explode_range(listings.filter((batch >= 1) & (limit >= 1)), limit, batch, "offset")
    length = F.least(batch, limit - F.col("offset")).cast("bigint")
    url = F.replace(
        F.replace(F.col(template), F.lit("{offset}"), F.col("offset").cast("string")), F.lit("{length}"), length.cast("string")
    )
    return pages.withColumns({"length": length, "url": url})


def start_pages(listings: DataFrame, template: str, batch_size: str, max_records: str) -> DataFrame:
    """{start} and {max_results} filled with full batches; other templates give one address."""
    text = F.col(template)
    paged = F.contains(text, F.lit("{start}")) & F.contains(text, F.lit("{max_results}"))
    limit = F.when(paged, F.col(max_records)).otherwise(F.lit(1))
    pages = _explode_range(listings, limit, F.col(batch_size), "start")
    url = F.replace(
        F.replace(text, F.lit("{start}"), F.col("start").cast("string")),
        F.lit("{max_results}"),
        F.col(batch_size).cast("string"),
    )
    return pages.withColumn("url", F.when(paged, url).otherwise(text))


def _numbered(listings: DataFrame, page_size: str, max_records: str) -> DataFrame:
    size, limit = F.col(page_size), F.col(max_records)
    last = F.ceil(limit / size).cast("bigint")
    return listings.filter((size >= 1) & (limit >= 1)).withColumn("page", F.explode(F.sequence(F.lit(1).cast("bigint"), last)))


def query_pages(listings: DataFrame, listing_url: str, page_size: str, max_records: str) -> DataFrame:
    """page=n merged into the query of the listing address."""
    pages = _numbered(listings, page_size, max_records)
    return pages.withColumn("url", with_page(F.col(listing_url), F.col("page")))


def path_pages(listings: DataFrame, listing_url: str, page_size: str, max_records: str) -> DataFrame:
    """/page/n/ appended, except for the first page."""
    base = F.regexp_replace(F.col(listing_url), "/+$", "")
    pages = _numbered(listings, page_size, max_records)
    return pages.withColumn(
        "url", F.when(F.col("page") > 1, F.concat(base, F.lit("/page/"), F.col("page").cast("string"), F.lit("/"))).otherwise(base)
    )
