"""Whitespace, case folding, token estimates and keyword rules."""

from __future__ import annotations

import sys
from functools import cache

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from lodegate.functions.binding import filled, let
from lodegate.functions.names import entity_key_text

# The whitespace characters recognised by Python's str.split.
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_UNCOLLAPSED = f"[{WHITESPACE.replace('-' + chr(92) + 'x20', '-' + chr(92) + 'x1f')}]|^ | $|  "

# Keyword and role family, in order of precedence.
ROLE_FAMILIES = (
    ("engineer", "Engineering"),
    ("research", "Research"),
    ("design", "Design"),
    ("sales", "Sales"),
    ("marketing", "Marketing"),
    ("product", "Product"),
)

# Company-form words dropped from the end of a name.
LEGAL_FORMS = (
    "inc", "incorporated", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "plc", "gmbh",
)


def strip(text: Column) -> Column:
    trimmed = lambda t: F.regexp_replace(t, f"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")
    return let(text, lambda t: F.when(t.rlike(f"^[{WHITESPACE}]|[{WHITESPACE}]$"), trimmed(t)).otherwise(t))


def collapse(text: Column) -> Column:
    """Runs of whitespace become one space; none is left at either end."""

    def collapsed(t):
        single = F.regexp_replace(t, f"[{WHITESPACE}]+", " ")
        return F.when(t.rlike(_UNCOLLAPSED), F.trim(single)).otherwise(t)

    return let(text, collapsed)


def present(text: Column) -> Column:
    """Collapsed text, or null when nothing is left."""
    return filled(collapse(text))


@cache
def _fold_rules() -> dict[str, str]:
    """Lower-case characters whose Unicode case folding is something else."""
    return {
        char: char.casefold()
        for char in map(chr, range(sys.maxunicode + 1))
        if char.casefold() != char and char.lower() == char
    }


def casefold(text: Column) -> Column:
    """Full Unicode case folding; the rarer rules run only for texts that may need them."""
    rules = _fold_rules()

    def substituted(value, pairs):
        for char, folded in pairs:
            value = F.replace(value, F.lit(char), F.lit(folded))
        return value

    near = [(char, folded) for char, folded in rules.items() if char <= "\xff"]
    far = [(char, folded) for char, folded in rules.items() if char > "\xff"]
    single = [(char, folded) for char, folded in far if len(folded) == 1]
    longer = [(char, folded) for char, folded in far if len(folded) > 1]
    chars = lambda pairs: "".join(char for char, _ in pairs)

    def folded_far(value):
        mapped = let(
            value,
            lambda v: F.when(
                v.rlike(f"[{chars(single)}]"), F.translate(v, chars(single), "".join(f for _, f in single))
            ).otherwise(v),
        )
        return let(mapped, lambda v: F.when(v.rlike(f"[{chars(longer)}]"), substituted(v, longer)).otherwise(v))

    def folded(low):
        return F.when(~low.rlike(r"[^\x00-\x7f]"), low).otherwise(
            let(
                substituted(low, near),
                lambda v: F.when(v.rlike(r"[^\x00-\xff]"), folded_far(v)).otherwise(v),
            )
        )

    return let(F.lower(text), folded)


def content_key_text(text: Column) -> Column:
    """Text used to compare contents: collapsed and case folded."""
    return casefold(collapse(text))


def estimate_tokens(text: Column) -> Column:
    """A quarter of the code points, rounded up; zero only for empty text."""
    return F.ceil(F.length(text) / F.lit(4))


def role_family(folded: Column) -> Column:
    rule = F
    for keyword, family in ROLE_FAMILIES:
        rule = rule.when(F.contains(folded, F.lit(keyword)), F.lit(family))
    return rule


def is_remote(folded: Column) -> Column:
    return F.contains(folded, F.lit("remote"))


def entity_key(name: Column) -> Column:
    """Comparison key of an organization name.

    ASCII names are keyed inside the JVM; only names with other characters
    reach the Python worker, which needs the Unicode decomposition tables.
    """
    ascii_only = name.rlike(r"^[\x00-\x7f]*$")
    words = F.regexp_replace(F.replace(F.lower(name), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")
    forms = "|".join(LEGAL_FORMS)
    kept = F.regexp_replace(F.trim(words), rf"(?:(?:^| )(?:{forms}))+$", "")
    return F.when(ascii_only, F.replace(kept, F.lit(" "))).otherwise(_unicode_key(F.when(~ascii_only, name)))


@F.pandas_udf(T.StringType())
def _unicode_key(names: pd.Series) -> pd.Series:
    return names.map(lambda name: entity_key_text(name, LEGAL_FORMS), na_action="ignore")


def unfenced(answer: Column) -> Column:
    """Model answer without the surrounding code fence."""
    text = strip(answer)
    inner = text
    for pattern in (r"^```json", r"^```", r"```$"):
        inner = F.regexp_replace(inner, pattern, "")
    return F.when(F.startswith(text, F.lit("```")), strip(inner)).otherwise(text)


def without_markup(text: Column) -> Column:
    """Feed field without CDATA wrappers; tags become spaces."""
    return strip(F.regexp_replace(without_cdata(text), r"<[^>]+>", " "))


def without_cdata(text: Column) -> Column:
    return F.regexp_replace(text, r"(?d)<!\[CDATA\[(.*?)\]\]>", "$1")


def slug(text: Column) -> Column:
    return F.replace(casefold(text), F.lit(" "), F.lit("_"))


def entity_slug(text: Column) -> Column:
    return F.replace(F.replace(casefold(text), F.lit(" "), F.lit("-")), F.lit("&"), F.lit("and"))


# A decimal number; Spark's cast alone would take a type letter behind it.
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_NOT_FINITE = r"(?i)^[+-]?(?:inf|infinity|nan)$"


def number(text: Column) -> Column:
    """The double that a text spells, else null."""
    return let(F.trim(text), lambda t: F.when(t.rlike(_NUMBER) | t.rlike(_NOT_FINITE), t.try_cast("double")))


def finite_number(text: Column) -> Column:
    return let(F.trim(text), lambda t: F.when(t.rlike(_NUMBER), t.try_cast("double")))


def whole_number(text: Column) -> Column:
    """The 64-bit integer that a text spells, exact; null for fractions, larger values and other texts.

    Plain digits never pass through a double; with an exponent a value counts up to 2^53.
    """
    digits = lambda t: F.regexp_extract(t, r"^([+-]?[0-9]+)\.?0*$", 1)
    scaled = lambda t: let(
        F.when(t.rlike(_NUMBER), t.try_cast("double")), lambda d: F.when((d == F.floor(d)) & (F.abs(d) <= float(1 << 53)), d.cast("bigint"))
    )
    return let(F.trim(text), lambda t: F.when(digits(t) != "", digits(t).try_cast("bigint")).otherwise(scaled(t)))
