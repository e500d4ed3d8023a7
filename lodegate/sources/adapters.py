"""Source adapters: which addresses a source has and how its documents are read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from lodegate.sources import archive, catalog, directories, feeds, pagination


@dataclass(frozen=True)
class Adapter:
    """Addresses of a listing table, and candidates of a table of landed documents.

    ``parse`` gets the documents with a ``position`` and a ``body`` (text, or
    binary for XML) and the current time.
    """

    source_id: str
    source_name: str
    record_type: str
    pages: Callable[[DataFrame], DataFrame]
    parse: Callable[[DataFrame, Column], DataFrame]


class Adapters:
    def __init__(self) -> None:
        self._by_id: dict[str, Adapter] = {}

    def register(self, adapter: Adapter) -> None:
        if adapter.source_id in self._by_id:
            raise ValueError(f"Source {adapter.source_id!r} is already registered")
        self._by_id[adapter.source_id] = adapter

    def get(self, source_id: str) -> Adapter:
        if source_id not in self._by_id:
            raise ValueError(f"No adapter for source {source_id!r}")
        return self._by_id[source_id]

    def __iter__(self):
        return iter(self._by_id.values())


def _feed(source_id: str, name: str, record_type: str) -> Adapter:
    candidates = feeds.news_candidates if record_type == "news" else feeds.job_candidates
    return Adapter(
        source_id, name, record_type,
        pages=lambda listings: listings.withColumnRenamed("feed_url", "url"),
        parse=lambda documents, now: candidates(feeds.feed_items(documents, "body", now)),
    )


def default_adapters() -> Adapters:
    """Adapters of the known sources; feeds of a catalog can be added to them."""
    known = Adapters()
    known.register(Adapter(
        "arxiv", "arXiv", "research_paper",
        pages=lambda listings: pagination.start_pages(listings, "endpoint", "batch_size", "max_records"),
        parse=lambda documents, now: feeds.atom_papers(documents, "body")[0],
    ))
    known.register(Adapter(
        "papers_with_code", "Papers with Code archive", "research_paper",
        pages=lambda listings: pagination.offset_pages(listings, "endpoint", "batch_size", "max_records"),
        parse=lambda documents, now: archive.archive_candidates(archive.archive_rows(documents, "body")),
    ))
    by_query = lambda listings: pagination.query_pages(listings, "listing_url", "page_size", "max_records")
    known.register(Adapter(
        "ycombinator", "Y Combinator", "startup", pages=by_query,
        parse=lambda documents, now: directories.organization_candidates(documents, "body", "position"),
    ))
    known.register(Adapter(
        "product_hunt", "Product Hunt", "product", pages=by_query,
        parse=lambda documents, now: directories.product_candidates(documents, "body", "position"),
    ))
    known.register(Adapter(
        "theres_an_ai_for_that", "There's An AI For That", "product",
        pages=lambda listings: pagination.path_pages(listings, "listing_url", "page_size", "max_records"),
        parse=lambda documents, now: directories.directory_cards(documents, "body", "position"),
    ))
    for record_type, table in (("news", catalog.NEWS_FEEDS), ("job", catalog.JOB_FEEDS)):
        for source_id, (name, _) in table.items():
            known.register(_feed(source_id, name, record_type))
    return known
