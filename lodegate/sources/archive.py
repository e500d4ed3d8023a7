"""Paper archive rows: JSON pages of wrapped rows to paper candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodegate.functions.binding import json_readings, stage
from lodegate.functions.identity import arxiv_url, canonical_url
from lodegate.functions.markup import is_object
from lodegate.functions.text import present
from lodegate.scale import parallel

_TEXT_FIELDS = ("paper_url", "paper_url_abs", "repo_url", "paper_title", "paper_arxiv_id", "framework")
_FLAG_FIELDS = ("is_official", "mentioned_in_paper", "mentioned_in_github")


# All fields of a row at once; by a path each, the row would be gone through for every field.
_FIELDS = f"struct<{', '.join(f'{name}: variant' for name in (*_TEXT_FIELDS, *_FLAG_FIELDS))}>"


def _text(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", present(F.try_variant_get(value, "$", "string")))


def _flag(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "boolean"), F.lit(False))


def _strictly_true(value: Column) -> Column:
    return F.coalesce((F.schema_of_variant(value) == "BOOLEAN") & F.try_variant_get(value, "$", "boolean"), F.lit(False))


def archive_rows(pages: DataFrame, body: str) -> DataFrame:
    """Row objects of each page; a page without a list of rows raises an error."""
    others = [c for c in pages.columns if c != body]
    # As ``json_value`` reads it, but in columns: inside one expression a page is read and copied several times.
    listed, held = json_readings(F.col(body))
    read = stage(parallel(pages), {"_listed": listed, "_held": held.isNotNull()})
    single = F.col("_held") & F.try_variant_get("_listed", "$[1]", "variant").isNull()
    rows = F.when(single, F.try_variant_get("_listed", "$[0].rows", "array<variant>"))
    checked = F.coalesce(rows, F.raise_error("Archive page has no rows list").cast("array<variant>"))
    wrapped = read.select(*others, F.posexplode(checked).alias("row_position", "_wrapped"))
    row = F.try_variant_get("_wrapped", "$.row", "variant")
    return stage(wrapped, {"row": row}, keep=lambda r: is_object(r["row"])).drop("_wrapped")


def archive_candidates(rows: DataFrame, *, official_only: bool = True) -> DataFrame:
    """Complete paper candidates; optionally only official implementations."""
    others = [c for c in rows.columns if c != "row"]
    read = stage(rows, {"row": F.try_variant_get("row", "$", _FIELDS)})
    field = lambda name: F.col(f"row.{name}")
    wanted = read.filter(_strictly_true(field("is_official"))) if official_only else read
    fields = {f"_{f}": _text(field(f)) for f in _TEXT_FIELDS} | {f"_{f}": _flag(field(f)) for f in _FLAG_FIELDS}
    complete = stage(
        wanted,
        fields,
        keep=lambda r: ~F.exists(F.array(*[r[f"_{f}"] for f in _TEXT_FIELDS[:5]]), lambda v: v.isNull()),
    )
    addressed = stage(
        complete,
        {"_paper": arxiv_url(F.col("_paper_url_abs")), "_canonical": canonical_url(F.col("_paper_url"))},
        keep=lambda r: r["_paper"].isNotNull() & r["_canonical"].isNotNull(),
    )
    return addressed.select(
        *others,
        F.col("_paper_url").alias("original_url"),
        F.col("_canonical").alias("canonical_url"),
        F.col("_paper").alias("paper_url"),
        F.col("_paper_title").alias("title"),
        F.col("_repo_url").alias("github_url"),
        F.col("_paper_arxiv_id").alias("arxiv_id"),
        F.col("_framework").alias("framework"),
        *[F.col(f"_{f}").alias(f) for f in _FLAG_FIELDS],
    )
