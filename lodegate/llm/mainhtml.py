"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. A line's weight is its text length without
that of links, and 0 where its elements say that it is no article text: menus, headers, footers,
asides, forms, notices, adverts, comments, scripts, hidden parts. Where the page marks its article,
a line inside weighs a surge more, links included, and of a line outside counts what is longer than
four surges. The distribution is the sum of weights over a sliding window of lines. A stretch of it
begins where it leaves 0 and dives where it is 0 again; it surges if its peak is over the threshold,
the same on every page. The weighted lines of the surging stretches are the text, short ones
included; on a page where none surges they are those of the highest.

Defined cases: a null or empty page and a page without a weighted line have the empty text; equal rows
get equal results; truncated and unclosed markup is read as far as it goes; an empty table gives
an empty one; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodegate.llm.context import prepare

WINDOW, SURGE = 3, 80
OUTSIDE = 4  # surges that a line outside a marked article has to exceed

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?P<close>>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?P<close2>>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_RAW = frozenset(("script", "style", "textarea", "title", "xmp", "noscript", "iframe", "noembed", "noframes"))
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
_BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html",
    "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td",
    "template", "tfoot", "th", "thead", "title", "tr", "ul",
))
_ASIDE = frozenset(("nav", "footer", "aside", "form", "head", "button", "select", "dialog", "menu", "template", "svg", "canvas", "object", "search"))
_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form"))
# Words of a class or id that name something beside the article.
_NAMED = frozenset((
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notices", "notification", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related", "reply", "replies",
    "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
))
_HEADS = frozenset(("header", "masthead", "topbar"))
_NEVER = frozenset(("html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "a", "b", "i", "em", "strong", "span"))
_NEGATED = frozenset(("no", "has", "with", "without", "hide"))
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _named(value: str) -> set[str]:
    words = [word.lower() for word in _NAME_PART.findall(value)]
    return {word for k, word in enumerate(words) if not (k and words[k - 1] in _NEGATED)}


def _role(name: str, attrs: str, in_article: bool) -> str:
    """'aside' for what is no article text, 'article' or 'main' for a marked article, else ''."""
    if name in _ASIDE or name == "header" and not in_article:
        return "aside"
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attrs)} if attrs.strip() else {}
    role = values.get("role", "").lower()
    if role in _ROLES or values.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs) or re.search(r"display\s*:\s*none", values.get("style", "")):
        return "aside"
    words = _named(values.get("class", "")) | _named(values.get("id", ""))
    if words and (name not in _NEVER or name == "article"):
        if words & _NAMED or not in_article and words & _HEADS:
            return "aside"
    if name == "article" or role == "article" or values.get("itemprop", "").lower() == "articlebody":
        return "article"
    return "main" if name == "main" or role == "main" else ""


def lines(html: str) -> list[tuple[str, bool, int, int]]:
    """(text, is article text as far as elements tell, 2 in an article and 1 in a main element, length of link text)."""
    out: list[tuple[str, bool, int, int]] = []
    held: list[str] = []
    links = 0
    stack: list[tuple[str, str]] = []  # open elements that have a role, and their namesakes inside
    open_roles = {"": 0, "aside": 0, "article": 0, "main": 0}
    anchors = 0

    def flush() -> None:
        nonlocal links
        text = " ".join(unescape("".join(held)).split()) if held else ""
        if text:
            out.append((text, not open_roles["aside"], 2 if open_roles["article"] else min(1, open_roles["main"]), links))
        held.clear()
        links = 0

    def say(text: str) -> None:
        nonlocal links
        held.append(text)
        if anchors:
            links += len(text)

    at = 0
    while at < len(html):
        match = _TOKEN.search(html, at)
        if match is None:
            say(html[at:])
            break
        if match.start() > at:
            say(html[at : match.start()])
        at = match.end()
        name = match["name"] or match["name2"]
        if name is None:
            continue
        name = name.lower()
        closing = match["end"] or match["end2"]
        if not (match["close"] or match["close2"]):
            break  # a tag cut off at the end of the page
        if name in _RAW and not closing:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            if name in _BLOCKS:
                flush()
            continue
        if name == "br":
            say(" ")
            continue
        if name == "a":
            anchors = max(0, anchors + (-1 if closing else 1))
            continue
        if name in _BLOCKS:
            flush()
        if name in _VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    for _, role in stack[k:]:
                        open_roles[role] -= 1
                    del stack[k:]
                    break
            continue
        attrs = match["attrs"] or match["attrs2"] or ""
        if attrs.endswith("/"):
            continue
        role = _role(name, attrs, open_roles["article"] > 0)
        if role or any(open_name == name for open_name, _ in stack):
            if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == name:
                open_roles[stack.pop()[1]] -= 1
            if role or any(open_name == name for open_name, _ in stack):
                stack.append((name, role))
                open_roles[role] += 1
    flush()
    return out


def weigh(found: list[tuple[str, bool, int, int]], surge: int = SURGE) -> np.ndarray:
    """The weight of each line; markup moves weights and decides nothing else."""
    # An article counts before the main element around it if it holds most of its text.
    inner, outer = (sum(len(text) for text, good, inside, _ in found if good and inside >= level) for level in (2, 1))
    marked = 0 if not outer else 2 if 2 * inner >= outer else 1

    def weight(text: str, good: bool, inside: int, link: int) -> int:
        if not good:
            return 0
        if not marked:
            return max(0, len(text) - link)
        return len(text) + surge if inside >= marked else max(0, len(text) - link - OUTSIDE * surge)

    return np.array([weight(*line) for line in found], dtype=np.int64)


def main_text(html: str, window: int = WINDOW, surge: int = SURGE) -> str:
    found = lines(html)
    if not found:
        return ""
    weights = weigh(found, surge)
    sums = np.concatenate([[0], np.cumsum(np.append(weights, np.zeros(window - 1, dtype=np.int64)))])
    blocks = sums[window:] - sums[:-window]  # of the lines k to k + window - 1
    # Each stretch over 0 rises from a line's start window to its dive; its peak tells whether it surges.
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (blocks > 0).astype(np.int8), [0]])))
    stretches = [(start, stop, blocks[start:stop].max()) for start, stop in zip(edges[::2], edges[1::2])]
    if not stretches:
        return ""
    least = min(surge + 1, max(peak for _, _, peak in stretches))
    kept = [k for start, stop, peak in stretches if peak >= least for k in range(start, stop) if weights[k]]
    return "\n".join(found[k][0] for k in kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(html) for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame, *, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and its code points n_chars, by one pass over the pages."""
    prepare(pages.sparkSession)
    given = pages.select(
        F.col(f"`{page}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"),
    )
    found = given.mapInArrow(_extract, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
