"""Heading-aware chunks of bounded size: splits of the text, and one greedy packing of sizes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lodegate.functions.binding import let
from lodegate.functions.text import strip

# Chunk size used when none is given, and characters that count as a token.
DEFAULT_TARGET_TOKENS = 5000
CHARS_PER_TOKEN = 4

_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
_BLANK = r"[\s\x1f]"
# Lines are stripped, so a heading has text behind its marks, on the same line.
_HEADING = r"(?U)^#{1,6}[\s\x1f&&[^\n]]+"


def tokens(text: Column) -> Column:
    return F.ceil(F.length(text) / CHARS_PER_TOKEN).cast("long")


def sentences(text: Column) -> Column:
    """Sentences of a paragraph, split after . ! or ? and blank space."""
    return F.filter(F.split(text, rf"(?U)(?<=[.!?]){_BLANK}+"), lambda s: s != "")


def packs(sizes: Column, target: int) -> Column:
    """Runs (start from 1, count) of an array of positive sizes: each is as long as fits the target.

    A size over the target is a run of its own.
    """

    def step(run: Column, size: Column) -> Column:
        opens = (run["at"] == 1) | (run["used"] + size > target)
        return F.struct(
            F.when(opens, F.concat(run["starts"], F.array(run["at"]))).otherwise(run["starts"]).alias("starts"),
            F.when(opens, size).otherwise(run["used"] + size).alias("used"),
            (run["at"] + 1).alias("at"),
        )

    start = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("used"), F.lit(1).alias("at"))
    counted = lambda starts, last: F.transform(
        starts, lambda begin, k: F.struct(begin.alias("start"), (F.coalesce(F.get(starts, k + 1), last) - begin).alias("count"))
    )
    return let(F.aggregate(sizes, start, step), lambda run: counted(run["starts"], run["at"]))


def _sections(text: Column) -> Column:
    """(section, paragraphs): the text cut before each heading line; blank lines end a paragraph."""
    lines = F.array_join(F.transform(F.split(text, _LINE_END), strip), "\n")
    parts = F.split(lines, r"(?Um)(?=^#{1,6}[\s\x1f&&[^\n]])")

    def read(part: Column) -> Column:
        headed = part.rlike(_HEADING)
        first = F.substring_index(part, "\n", 1)
        section = F.when(headed, strip(F.regexp_replace(first, _HEADING, "")))
        body = F.when(headed, F.substr(part, F.length(first) + 1)).otherwise(part)
        filled = F.filter(F.transform(F.split(body, r"\n{2,}"), lambda p: F.btrim(p, F.lit("\n"))), lambda p: p != "")
        paragraphs = F.transform(filled, lambda p: F.regexp_replace(p, "\n", " "))
        return F.struct(F.when(section != "", section).alias("section"), paragraphs.alias("paragraphs"))

    return F.transform(parts, read)


def _pieces(paragraph: Column, target: int) -> Column:
    """The paragraph where it fits, else runs of its sentences; a longer sentence is sliced."""
    width = target * CHARS_PER_TOKEN
    sliced = lambda s: F.transform(
        F.sequence(F.lit(1), F.length(s), F.lit(width)), lambda at: F.substr(s, at, F.lit(width))
    )

    def run(parts: Column, pack: Column) -> Column:
        alone = F.get(parts, pack["start"] - 1)
        whole = F.array(F.array_join(F.slice(parts, pack["start"], pack["count"]), " "))
        return F.when((pack["count"] == 1) & (F.length(alone) > width), sliced(alone)).otherwise(whole)

    packed = let(
        sentences(paragraph),
        lambda parts: F.flatten(F.transform(packs(F.transform(parts, tokens), target), lambda pack: run(parts, pack))),
    )
    return F.when(F.length(paragraph) <= width, F.array(paragraph)).otherwise(packed)


def document_chunks(text: Column, target_tokens: int = DEFAULT_TARGET_TOKENS) -> Column:
    """Chunks (sequence, section, text, token_estimate) of a text in reading order.

    Each keeps the first section it covers. A null text has null, a blank one no chunks.
    """
    if target_tokens < 1:
        raise ValueError("target_tokens must be positive")
    pieces = F.flatten(
        F.transform(
            _sections(text),
            lambda s: F.transform(
                F.flatten(F.transform(s["paragraphs"], lambda p: _pieces(p, target_tokens))),
                lambda piece: F.struct(s["section"].alias("section"), piece.alias("text")),
            ),
        )
    )

    def chunk(all_: Column, pack: Column, sequence: Column) -> Column:
        members = F.slice(all_, pack["start"], pack["count"])
        named = F.filter(F.transform(members, lambda m: m["section"]), lambda s: s.isNotNull())
        return let(
            F.array_join(F.transform(members, lambda m: m["text"]), "\n\n"),
            lambda joined: F.struct(
                sequence.alias("sequence"), F.get(named, F.lit(0)).alias("section"), joined.alias("text"), tokens(joined).alias("token_estimate")
            ),
        )

    return let(
        pieces,
        lambda all_: F.transform(
            packs(F.transform(all_, lambda m: tokens(m["text"])), target_tokens), lambda pack, k: chunk(all_, pack, k)
        ),
    )
