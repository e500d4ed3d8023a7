"""Name an intermediate value inside one column expression.

A bound value is evaluated once per row however often it is used, and the
expression stays small enough for whole-stage code generation around it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    # Taking an element out of a transformed array asks for its type, through all of the body, on every row.
    return F.aggregate(F.array(), value, lambda bound, _: bound, body)


def filled(text: Column) -> Column:
    """The text itself, or null when it is empty."""
    return let(text, lambda t: F.when(t != "", t))


def stage(
    df: DataFrame, columns: dict[str, Column], keep: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add or replace columns and keep the rows where ``keep(new columns)`` holds.

    The columns come out of a generator, so later filters and projections read
    the values instead of repeating the expressions behind them.
    """
    rows = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    kept = rows if keep is None else F.filter(rows, keep)
    return df.select(*[c for c in df.columns if c not in columns], F.inline(kept))


def json_readings(text: Column) -> tuple[Column, Column]:
    """The text read inside a list and inside an object, the two readings that ``json_value`` compares."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))


def json_value(text: Column) -> Column:
    """The single JSON value a text holds; null when broken or followed by anything else.

    The parser stops after the first value. What follows cannot close both an
    array and an object, so a text that parses inside both has nothing after it.
    """
    listed, held = json_readings(text)
    return let(
        F.when(held.isNotNull(), listed),
        lambda v: F.when(F.try_variant_get(v, "$[1]", "variant").isNull(), F.try_variant_get(v, "$[0]", "variant")),
    )


def matched(text: Column, pattern: str, groups: int, body: Callable[[Callable[[int], Column]], Column]) -> Column:
    """``body(group)`` when the anchored ``pattern`` matches, else null.

    ``group(i)`` is the text of capture group ``i``, empty when it took no part.
    All groups come from one match.
    """
    joined = "\x00".join(f"${i}" for i in range(1, groups + 1))
    found = let(text, lambda t: F.when(t.rlike(pattern), F.split(F.regexp_replace(t, pattern, joined), r"\x00")))
    return let(found, lambda g: F.when(g.isNotNull(), body(lambda i: F.get(g, F.lit(i - 1)))))
