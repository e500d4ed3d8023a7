"""Columns over HTML, JSON-LD and feed documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from lodegate.functions.batches import arrow_rows
from lodegate.functions.binding import filled, json_value, let
from lodegate.functions.dates import (
    ARTICLE_CONFIDENCE,
    dated_text,
    first_evidence,
    mentioned_relative_timestamp,
    page_timestamp,
)
from lodegate.functions.text import casefold, collapse, strip
from lodegate.functions.readers import (
    AUTHOR_META_NAMES,
    DATE_META_NAMES,
    EVIDENCE_META_NAMES,
    FEED_ELEMENTS,
    page_events,
    read_atom,
    read_feed,
)


def _record(texts: tuple[str, ...], lists: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in texts]
        + [T.StructField(name, T.ArrayType(T.StringType())) for name in lists]
    )


_FLAGS = ("hidden", "title", "article", "p", "closed")
EVENTS = T.ArrayType(
    T.StructType(
        [T.StructField(name, T.StringType()) for name in ("kind", "tag", "text")]
        + [T.StructField("attributes", T.MapType(T.StringType(), T.StringType()))]
        + [T.StructField(name, T.BooleanType()) for name in _FLAGS]
    )
)
FEED_ROWS = T.ArrayType(_record((*FEED_ELEMENTS, "href")))
ATOM_ROWS = T.ArrayType(_record(("id", "published", "title", "summary"), ("authors",)))

# Shortest text taken as an article body, and shortest body kept over a fallback.
MIN_ARTICLE_CHARS = 150
MIN_BODY_CHARS = 50

# Signs of an anti-bot page, and the shortest useful body in bytes.
CHALLENGE_MARKERS = (
    "cf-browser-verification", "challenge-platform", "just a moment", "checking your browser",
    "ddos protection by", "attention required", "datadome",
)
BLOCKED_STATUS = (403, 503)
MIN_USEFUL_BYTES = 150


# Text that tells an age, and a date inside a JSON-LD script.
AGE_PATTERN = r"(?iU)\b\d+\s+(?:minutes?|hours?|days?)\s+ago\b"
DATED_PATTERN = r'"(?:datePublished|dateCreated|published_at)"\s*:\s*"([^"]+)"'


# Characters of markup whose events are held as Python objects at once; a longer page stands alone.
EVENTS_AT_ONCE = 1 << 20


def _some_pages(html: pa.Array) -> Iterator[pa.Array]:
    """Slices of a batch, of about ``EVENTS_AT_ONCE`` characters."""
    start = held = 0
    for at, length in enumerate(pc.utf8_length(html).to_pylist()):
        if held and held + (length or 0) > EVENTS_AT_ONCE:
            yield html.slice(start, at - start)
            start, held = at, 0
        held += length or 0
    yield html.slice(start)


def _events(html: pa.Array) -> pa.Array:
    """Events of some pages as flat columns, cut into one list per page."""
    rows: list[tuple] = []
    offsets, closed, absent = [0], [], []
    for page in html.to_pylist():
        last = len(rows) if page is None else page_events(page, rows)
        closed += [True] * (last - offsets[-1]) + [False] * (len(rows) - last)
        offsets.append(len(rows))
        absent.append(page is None)
    fields = to_arrow_type(EVENTS.elementType)
    columns = list(zip(*rows)) if rows else [()] * (len(fields) - 1)
    told = pa.StructArray.from_arrays([pa.array(values, field.type) for values, field in zip([*columns, closed], fields)], fields=list(fields))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), told, type=to_arrow_type(EVENTS), mask=pa.array(absent, pa.bool_()))


@F.arrow_udf(EVENTS)
def events(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """All events of each page. Slices leave as they are read, so a batch of many pages is never held as objects."""
    for html in batches:
        yield from map(_events, _some_pages(html))


def _of(found: Column, kind: str, tag: str | None = None) -> Column:
    return F.filter(found, lambda e: (e["kind"] == kind) & (F.lit(True) if tag is None else e["tag"] == tag))


def _meta(found: Column, names: tuple[str, ...]) -> Column:
    """Attributes of the meta elements that are called one of ``names``."""
    attribute = lambda e, name: filled(F.get(F.filter(F.map_entries(e["attributes"]), lambda a: a["key"] == name), F.lit(0))["value"])
    called = lambda e: casefold(F.coalesce(attribute(e, "property"), attribute(e, "name"), F.lit("")))
    return F.transform(F.filter(_of(found, "element", "meta"), lambda e: called(e).isin(*names)), lambda e: e["attributes"])


def _present(values: Column) -> Column:
    return F.filter(values, lambda v: F.coalesce(v, F.lit("")) != "")


def _last(values: Column) -> Column:
    return F.get(values, F.size(values) - 1)


def article_pieces(html: Column) -> Column:
    """Title, author, the texts of three scopes, and what may hold dates, of one page."""
    return let(events(html), _article_pieces)


def _article_pieces(found: Column) -> Column:
    shown = F.filter(found, lambda e: (e["kind"] == "break") | (e["kind"] == "text") & ~e["hidden"])
    # The first text of a title is no part of the page; where it stands is told by its number.
    numbered = F.transform(shown, lambda e, k: F.struct(e["kind"].alias("kind"), e["text"].alias("text"), e["title"].alias("title"), e["article"].alias("article"), e["p"].alias("p"), k.alias("at")))

    def pieces(texts: Column, title: Column) -> Column:
        rest = F.filter(texts, lambda e: ~e["at"].eqNullSafe(title["at"]))
        joined = lambda values: collapse(F.array_join(values, ""))
        plain = F.filter(rest, lambda e: e["kind"] == "text")
        in_paragraphs = F.filter(rest, lambda e: (e["kind"] == "break") | e["p"])
        times = F.transform(_of(found, "element", "time"), lambda e: F.coalesce(filled(e["attributes"]["datetime"]), e["attributes"]["data-time"]))
        authors = F.transform(_meta(found, AUTHOR_META_NAMES), lambda a: strip(a["content"]))
        return F.struct(
            collapse(title["text"]).alias("title"),
            F.get(_present(authors), F.lit(0)).alias("author"),
            joined(F.transform(F.filter(plain, lambda e: e["article"]), lambda e: e["text"])).alias("article_text"),
            joined(F.transform(in_paragraphs, lambda e: F.when(e["kind"] == "break", "\n").otherwise(e["text"]))).alias("paragraph_text"),
            joined(F.transform(plain, lambda e: e["text"])).alias("page_text"),
            F.transform(_of(found, "data"), lambda e: e["text"]).alias("linked_data"),
            _present(F.transform(_meta(found, DATE_META_NAMES), lambda a: a["content"])).alias("meta_dates"),
            _present(times).alias("time_dates"),
        )

    titles = lambda texts: F.get(F.filter(texts, lambda e: (e["kind"] == "text") & e["title"]), F.lit(0))
    return F.when(found.isNotNull(), let(numbered, lambda texts: let(titles(texts), lambda title: pieces(texts, title))))


def evidence_pieces(html: Column) -> Column:
    """The last date text of each kind found in a page."""
    return let(events(html), _evidence_pieces)


def _evidence_pieces(found: Column) -> Column:
    texts = _of(found, "text")
    aged = lambda e: e["text"].rlike(AGE_PATTERN)
    dated = F.transform(_of(found, "data"), lambda e: F.regexp_extract(e["text"], DATED_PATTERN, 1))
    shown = F.transform(F.filter(texts, lambda e: e["closed"] & ~aged(e)), lambda e: strip(e["text"]))
    return F.when(
        found.isNotNull(),
        F.struct(
            _last(_present(dated)).alias("json_ld"),
            _last(_meta(found, EVIDENCE_META_NAMES))["content"].alias("meta"),
            _last(_of(found, "element", "time"))["attributes"]["datetime"].alias("time"),
            filled(F.array_join(shown, " ")).alias("visible"),
            strip(_last(F.filter(texts, aged))["text"]).alias("relative"),
        ),
    )


def _once(udf: Callable[..., Column]) -> Callable[..., Column]:
    """Keeps the optimizer from copying the function into filters that it makes up, which would read every document again."""
    return udf.asNondeterministic()


@_once
@F.arrow_udf(FEED_ROWS)
def feed_rows(body: pa.Array) -> pa.Array:
    return arrow_rows(body, read_feed, FEED_ROWS)


@_once
@F.arrow_udf(ATOM_ROWS)
def atom_rows(body: pa.Array) -> pa.Array:
    return arrow_rows(body, read_atom, ATOM_ROWS)


def article_body(pieces: Column, fallback: Column) -> Column:
    """Article text, else paragraphs, else the whole page; a short body yields to the fallback."""
    body = (
        F.when(F.length(pieces["article_text"]) >= MIN_ARTICLE_CHARS, pieces["article_text"])
        .when(F.length(pieces["paragraph_text"]) >= MIN_ARTICLE_CHARS, pieces["paragraph_text"])
        .otherwise(pieces["page_text"])
    )
    return F.when((F.length(body) < MIN_BODY_CHARS) & (F.coalesce(fallback, F.lit("")) != ""), fallback).otherwise(body)


def article_date(pieces: Column, body: Column, now: Column) -> Column:
    """Struct (published_at, source, confidence) of the best date in a page."""
    nodes = F.flatten(F.transform(pieces["linked_data"], lambda text: linked_data_nodes(text, nested=True)))
    dates = F.flatten(
        F.transform(
            nodes,
            lambda node: F.array(*[text_field(node, f"$.{k}") for k in ("datePublished", "dateCreated", "dateModified")]),
        )
    )
    marked = {"json_ld": F.filter(dates, lambda d: d.isNotNull()), "meta": pieces["meta_dates"], "time": pieces["time_dates"]}
    tagged = [_tagged(texts, source) for source, texts in marked.items()]
    ago = let(
        mentioned_relative_timestamp(body, now),
        lambda at: F.when(
            at.isNotNull(),
            F.struct(
                at.alias("published_at"), F.lit("relative").alias("source"),
                F.lit(ARTICLE_CONFIDENCE["relative"]).alias("confidence"),
            ),
        ),
    )
    return let(
        first_evidence(F.concat(*tagged), page_timestamp),
        lambda found: F.when(found["published_at"].isNotNull(), found).otherwise(F.coalesce(ago, found)),
    )


def _tagged(texts: Column, source: str) -> Column:
    return F.transform(texts, lambda raw: dated_text(raw, source, ARTICLE_CONFIDENCE[source]))


def article_author(pieces: Column) -> Column:
    nodes = F.flatten(F.transform(pieces["linked_data"], lambda text: linked_data_nodes(text, nested=True)))
    names = F.transform(
        nodes, lambda node: F.coalesce(F.try_variant_get(node, "$.author.name", "string"), text_field(node, "$.author"))
    )
    return F.coalesce(pieces["author"], F.get(F.filter(names, lambda n: n.isNotNull()), F.lit(0)))


def is_thin_page(status: Column, body: Column) -> Column:
    """True when a response looks blocked or has too little content; ``body`` is binary."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.translate(F.decode(body, "ISO-8859-1"), upper, lower)
    marked = F.lit(False)
    for marker in CHALLENGE_MARKERS:
        marked = marked | F.contains(text, F.lit(marker))
    return status.isin(*BLOCKED_STATUS) | (F.octet_length(body) < MIN_USEFUL_BYTES) | marked


# JSON-LD ------------------------------------------------------------------


def linked_data_scripts(html: Column) -> Column:
    """Contents of the JSON-LD script elements of a page, comments skipped."""
    pattern = r"(?is)<!--.*?-->|<script\b([^>]*)>(.*?)</script\s*>"
    attributes = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    bodies = F.regexp_extract_all(html, F.lit(pattern), F.lit(2))
    typed = r"""(?i)(?:^|\s)type\s*=\s*(?-i:"application/ld\+json"|'application/ld\+json'|application/ld\+json(?=[\s/]|$))"""
    chosen = F.filter(F.arrays_zip(attributes.alias("a"), bodies.alias("b")), lambda s: s["a"].rlike(typed))
    return F.transform(chosen, lambda s: s["b"])


def kind(value: Column) -> Column:
    """JSON type of a variant: OBJECT, ARRAY, STRING, BIGINT, BOOLEAN, ..."""
    return F.regexp_extract(F.schema_of_variant(value), r"^([A-Z]+)", 1)


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value) == "OBJECT", F.lit(False))


def _elements(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def linked_data_nodes(script: Column, nested: bool = False) -> Column:
    """Object nodes of one JSON-LD text: a list, the @graph of an object, or the object.

    With ``nested``, objects inside a list may bring their own @graph.
    """

    def own_nodes(value):
        return F.coalesce(_elements(value, "$['@graph']"), F.array(value))

    def nodes(value):
        items = _elements(value, "$")
        if nested:
            items = F.flatten(F.transform(F.filter(items, is_object), own_nodes))
        found = F.when(kind(value) == "ARRAY", items).when(kind(value) == "OBJECT", own_nodes(value))
        return F.filter(found, is_object)

    return F.coalesce(let(json_value(script), nodes), F.array().cast("array<variant>"))


def text_field(node: Column, path: str) -> Column:
    """Trimmed JSON string at ``path``; null for other types and blank text."""
    return let(
        F.try_variant_get(node, path, "variant"),
        lambda v: F.when(kind(v) == "STRING", filled(strip(F.try_variant_get(v, "$", "string")))),
    )


def integer_field(node: Column, path: str) -> Column:
    return let(
        F.try_variant_get(node, path, "variant"),
        lambda v: F.when(kind(v) == "BIGINT", F.try_variant_get(v, "$", "bigint")),
    )
