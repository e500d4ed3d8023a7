"""URL and content identities built only from JVM expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from lodegate.functions.binding import let, matched

# Query keys that carry no meaning, besides every utm_ key.
TRACKING_KEYS = ("fbclid", "gclid", "mc_cid", "mc_eid")

_PARTS = r"(?s)^(?i:https?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_HOST_PORT = r"(?s)^(?:\[([^\]]*)\]|([^:\[]*))(?::(.*))?$"
_TRACKED = r"utm_[A-Za-z0-9._~=-]*"
_PLAIN = rf"^https?://[a-z0-9.-]+(?:/[A-Za-z0-9._~/@:-]*)?(?:\?&*{_TRACKED}(?:&+{_TRACKED})*&*|\?&*)?(?:#[!-~]*)?$"
_PLAIN_REPOSITORY = r"^https?://(?:www\.)?github\.com/[A-Za-z0-9._-]+/(?!\.git/?\z)[A-Za-z0-9._-]+/?\z"
_UNIT = "\x1f"


def _clean(url: Column) -> Column:
    """Drop the characters URL parsers ignore: leading blanks, tabs, line breaks."""
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")


def _percent_decode(text: Column) -> Column:
    """Decode escapes; broken escapes and plus signs stay as they are."""
    safe = F.replace(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.when(F.contains(text, F.lit("%")), F.try_url_decode(safe)).otherwise(text)


def _replace_all(text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _encode_path(text: Column) -> Column:
    pairs = (("+", "%20"), ("%7E", "~"), ("*", "%2A"), ("%2F", "/"), ("%3A", ":"), ("%40", "@"), ("%25", "%"))
    return F.when(text.rlike("^[A-Za-z0-9._~/:@%-]*$"), text).otherwise(_replace_all(F.url_encode(text), pairs))


def _encode_form(text: Column) -> Column:
    encoded = _replace_all(F.url_encode(text), (("%7E", "~"), ("*", "%2A")))
    return F.when(text.rlike("^[A-Za-z0-9._~-]*$"), text).otherwise(encoded)


def _decode_form(text: Column) -> Column:
    return _percent_decode(F.replace(text, F.lit("+"), F.lit(" ")))


def query_pairs(query: Column) -> Column:
    """Array of (k, v) structs of a query string; blank values are kept."""
    pieces = F.filter(F.split(query, "&"), lambda piece: piece != "")

    def pair(piece):
        key = F.substring_index(piece, "=", 1)
        value = F.substring(piece, F.length(key) + 2, F.length(piece))
        return F.struct(_decode_form(key).alias("k"), _decode_form(value).alias("v"))

    return F.transform(pieces, pair)


def encode_pairs(pairs: Column) -> Column:
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(_encode_form(p["k"]), F.lit("="), _encode_form(p["v"]))), "&"
    )


def _address(url: Column, body: Callable[[dict[str, Column]], Column]) -> Column:
    """``body(parts)`` for an absolute http(s) URL with a host and a valid port, else null."""

    def with_parts(g):
        def with_host(h):
            host, port = F.lower(F.concat(h(1), h(2))), h(3)
            number = port.try_cast("int")
            valid = (port == "") | (port.rlike("^[0-9]+$") & (number <= 65535))
            parts = {"userinfo": F.contains(g(1), F.lit("@")), "host": host, "port": number, "path": g(2), "query": g(3)}
            return F.when((host != "") & valid, body(parts))

        return matched(F.regexp_replace(g(1), r"(?s)^.*@", ""), _HOST_PORT, 3, with_host)

    return matched(_clean(url), _PARTS, 3, with_parts)


def _canonical(parts: dict[str, Column]) -> Column:
    default_port = parts["port"].isNull() | parts["port"].isin(80, 443)
    authority = F.when(default_port, parts["host"]).otherwise(
        F.concat(parts["host"], F.lit(":"), parts["port"].cast("string"))
    )
    decoded = let(F.when(parts["path"] == "", "/").otherwise(parts["path"]), _percent_decode)
    path = let(
        let(decoded, _encode_path),
        lambda p: F.when((p == "/") | ~F.endswith(p, F.lit("/")), p).otherwise(F.rtrim(p, F.lit("/"))),
    )
    kept = F.filter(
        query_pairs(parts["query"]),
        lambda p: ~F.lower(p["k"]).isin(*TRACKING_KEYS) & ~F.startswith(F.lower(p["k"]), F.lit("utm_")),
    )
    query = F.when(parts["query"] == "", "").otherwise(
        let(encode_pairs(F.array_sort(kept)), lambda q: F.when(q == "", q).otherwise(F.concat(F.lit("?"), q)))
    )
    return F.concat(F.lit("https://"), authority, path, query)


def canonical_url(raw: Column) -> Column:
    """One spelling per address; null when ``raw`` is not an absolute http(s) URL.

    Addresses already plain in host and path, with no query but utm_ keys, skip the general rules.
    """

    def spelled(url):
        tail = F.regexp_replace(url, "^https?://|[?#].*$", "")
        plain = let(
            tail,
            lambda t: F.when(t.rlike("^[^/]+/?$"), F.concat(F.rtrim(t, F.lit("/")), F.lit("/"))).otherwise(
                F.rtrim(t, F.lit("/"))
            ),
        )
        return F.when(url.rlike(_PLAIN), F.concat(F.lit("https://"), plain)).otherwise(_address(url, _canonical))

    return let(raw, spelled)


def is_http_url(raw: Column) -> Column:
    """An absolute http(s) address; most are seen to be one at once."""
    return F.coalesce(raw.rlike(_PLAIN) | _address(raw, lambda parts: F.lit(True)), F.lit(False))


def content_hash(body: Column) -> Column:
    return F.sha2(body, 256)


def record_id(source_id: Column, canonical: Column) -> Column:
    return F.sha2(F.concat(source_id, F.lit(_UNIT), canonical), 256)


def raw_document_id(source_id: Column, canonical: Column, body_hash: Column) -> Column:
    return F.sha2(F.concat(source_id, F.lit(_UNIT), canonical, F.lit(_UNIT), body_hash), 256)


def arxiv_url(raw: Column) -> Column:
    """Version-free abstract address; null unless the path is an abstract page."""
    paper = F.regexp_extract(
        canonical_url(raw), r"^https://[^/?]*/abs/([a-z-]+/[0-9]{7}|[0-9]{4}\.[0-9]{4,5})(?:v[0-9]+)?(?:\?.*)?$", 1
    )
    return F.when(paper != "", F.concat(F.lit("https://arxiv.org/abs/"), paper))


def _repository(parts: dict[str, Column]) -> Column:
    public = (
        parts["host"].isin("github.com", "www.github.com")
        & ~parts["userinfo"]
        & (parts["port"].isNull() | parts["port"].isin(80, 443))
    )

    def address(names):
        name = F.regexp_replace(F.get(names, F.lit(1)), r"\.git$", "")
        return F.when(
            (F.size(names) == 2) & (name != ""),
            F.lower(F.concat(F.lit("https://github.com/"), F.get(names, F.lit(0)), F.lit("/"), name)),
        )

    names = F.filter(F.split(parts["path"], "/"), lambda part: part != "")
    return F.when(public, let(names, address))


def repository_url(raw: Column) -> Column:
    """Lower-case https://github.com/owner/repository, or null for anything else.

    Addresses of plain letters with an owner and a name, nearly all, skip the general rules.
    """
    plain = F.lower(F.regexp_replace(raw, r"^https?://(?:www\.)?|\.git/?\z|/\z", ""))
    return F.when(raw.rlike(_PLAIN_REPOSITORY), F.concat(F.lit("https://"), plain)).otherwise(_address(raw, _repository))


def repository_owner(normalized: Column) -> Column:
    return F.regexp_extract(normalized, r"^https://[^/]+/([^/]+)/([^/]+)$", 1)


def repository_name(normalized: Column) -> Column:
    return F.regexp_extract(normalized, r"^https://[^/]+/([^/]+)/([^/]+)$", 2)


def with_page(listing_url: Column, page: Column) -> Column:
    """Listing address with ``page`` merged into its query, the last value of a key winning."""
    pattern = r"(?s)^([^?#]*)(?:\?([^#]*))?(#.*)?$"
    head = F.regexp_extract(listing_url, pattern, 1)
    pairs = query_pairs(F.regexp_extract(listing_url, pattern, 2))
    entries = F.transform(pairs, lambda p: F.struct(p["k"].alias("key"), p["v"].alias("value")))
    extra = F.array(F.struct(F.lit("page").alias("key"), page.cast("string").alias("value")))
    merged = F.transform(
        F.map_entries(F.map_from_entries(F.concat(entries, extra))),
        lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v")),
    )
    fragment = F.regexp_extract(listing_url, pattern, 3)
    return F.concat(head, F.lit("?"), encode_pairs(merged), F.when(fragment == "#", "").otherwise(fragment))


# File name extension per media type; anything else is .bin.
EXTENSIONS = {
    "application/atom+xml": ".xml",
    "application/xml": ".xml",
    "text/xml": ".xml",
    "application/json": ".json",
    "text/html": ".html",
}


def extension(content_type: Column) -> Column:
    media = F.lower(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1))
    table = F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, media), F.lit(".bin"))


def storage_key(source_id: Column, retrieved_at: Column, body_hash: Column, content_type: Column) -> Column:
    """Content-addressed path source/yyyy/MM/dd/hash.ext."""
    return F.concat_ws(
        "/", source_id, F.date_format(retrieved_at, "yyyy/MM/dd"), F.concat(body_hash, extension(content_type))
    )
