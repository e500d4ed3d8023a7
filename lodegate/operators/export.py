"""The six export tabs: cells, headers, CSV folders and sheet requests."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lodegate.functions.cells import tabularize
from lodegate.operators.running import running
from lodegate.session import materialize

# Export tabs in order and the table behind each.
TAB_TABLES = {
    "Startups": "startups",
    "Products": "products",
    "Research Papers": "research_papers",
    "Jobs": "jobs",
    "News": "news",
    "Entity Mapping Log": "entity_mapping_log",
}
REQUIRED_TABS = tuple(TAB_TABLES)
EMPTY_HEADER = "record"
LOG_ORDER = ("batch", "mappingId")  # where a row stands in an appended log; no cells


def check_tabs(names: Collection[str]) -> None:
    unknown = sorted(set(names) - set(REQUIRED_TABS))
    if unknown:
        raise ValueError(f"Unknown export tabs: {unknown}")


def file_name(tab: str) -> str:
    return tab.casefold().replace(" ", "_")


def payload_cells(records: DataFrame, payload: str) -> DataFrame:
    """Top-level fields of JSON records as a map of text cells, column ``cells``."""
    others = [c for c in records.columns if c != payload]
    fields = F.from_json(F.col(payload), T.MapType(T.StringType(), T.VariantType()))
    return records.select(*others, F.transform_values(fields, lambda _, v: _cell(v)).alias("cells")).select(
        *others, _sorted_nested("cells").alias("cells")
    )


def _cell(value: Column) -> Column:
    """Cell text of a JSON value; nested values stay JSON and are normalized afterwards."""
    shape = F.schema_of_variant(value)
    nested = F.startswith(shape, F.lit("OBJECT")) | F.startswith(shape, F.lit("ARRAY"))
    text = F.when(nested, F.concat(F.lit("\x00"), F.to_json(value))).when(
        shape == "BOOLEAN", F.initcap(value.cast("string"))
    ).otherwise(value.cast("string"))
    return F.coalesce(F.when(F.is_variant_null(value), "").otherwise(text), F.lit(""))


def _sorted_nested(cells: str) -> Column:
    """Rewrite the marked JSON cells with sorted keys, all cells of a row in one call."""
    entries = F.map_entries(cells)
    nested = F.to_json(F.transform(entries, lambda e: F.when(F.startswith(e["value"], F.lit("\x00")), F.substr(e["value"], F.lit(2)))), {"ignoreNullFields": "false"})
    rewritten = F.from_json(_normalize_list(nested), T.ArrayType(T.StringType()))
    return F.map_from_arrays(
        F.map_keys(cells), F.zip_with(F.map_values(cells), rewritten, lambda old, new: F.coalesce(new, old))
    )


@F.pandas_udf(T.StringType())
def _normalize_list(texts: pd.Series) -> pd.Series:
    def normal(text):
        return json.dumps([None if item is None else json.dumps(json.loads(item), sort_keys=True) for item in json.loads(text)])

    return texts.map(normal, na_action="ignore")


def header_union(rows: DataFrame, cells: str, order: str) -> DataFrame:
    """Distinct headers in order of first appearance: (header, position)."""
    seen = rows.select(F.col(order).alias("_row"), F.posexplode(F.map_keys(cells)).alias("_at", "header"))
    first = seen.groupBy("header").agg(F.min(F.struct("_row", "_at")).alias("_first"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_first", "header"))), lambda s: s["header"])
    return first.agg(ordered.alias("_headers")).select(F.posexplode("_headers").alias("position", "header"))


def headers_of(rows: DataFrame, cells: str, order: str) -> list[str]:
    """Header list for the writers; as long as the widest schema, never the data."""
    return [row["header"] for row in header_union(rows, cells, order).orderBy("position").collect()]


def matrix(rows: DataFrame, cells: str, order: str, headers: list[str]) -> DataFrame:
    """(order, values): the cells of each row along the headers, gaps empty."""
    values = F.array(*[F.coalesce(F.try_element_at(F.col(cells), F.lit(h)), F.lit("")) for h in headers])
    return rows.select(order, values.alias("values"))


def tab_counts(tabs: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per tab."""
    check_tabs(tabs)
    counts = None
    for name in REQUIRED_TABS:
        if name in tabs:
            one = tabs[name].agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("tab"), "records")
            counts = one if counts is None else counts.unionByName(one)
    return counts


def _shown(tab: DataFrame | None) -> DataFrame | None:
    """A tab's cells along its headers in the order of its key, or None if it has no row."""
    if tab is None or tab.isEmpty():
        return None
    placed = [name for name in LOG_ORDER if name in tab.columns]
    if "payload" not in tab.columns and placed:
        return tabularize(tab.orderBy(*placed).drop(*placed))
    if "payload" not in tab.columns:
        rows = tabularize(tab)
        return rows.orderBy(rows.columns[0])
    key = next(name for name in tab.columns if name != "payload")
    celled = materialize(payload_cells(tab, "payload").select(F.col(key).alias("_key"), "cells"), "cells")
    headers = headers_of(celled, "cells", "_key")
    cell = lambda h: F.coalesce(F.try_element_at(F.col("cells"), F.lit(h)), F.lit(""))
    return celled.orderBy("_key").select(*[cell(h).alias(h) for h in headers])


def write_csv(tabs: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write every required tab as a folder of CSV parts with a header; returns the paths.

    A stored tab, with a JSON ``payload``, has the fields of its payloads as headers, in the order
    in which they first appear; other tabs have their columns. A tab that is absent or has no row
    has the header ``record`` alone. Parts stay in parallel; rows are ordered inside and between
    parts by the tab's key.
    """
    check_tabs(tabs)
    paths = {}
    for name in REQUIRED_TABS:
        rows = _shown(tabs.get(name))
        paths[name] = f"{folder.rstrip('/')}/{file_name(name)}"
        if rows is None:
            spark = next(iter(tabs.values())).sparkSession if tabs else SparkSession.getActiveSession()
            rows = spark.createDataFrame([], f"{EMPTY_HEADER} string")
        rows.write.mode("overwrite").option("header", True).option("emptyValue", "").option(
            "escape", '"'
        ).csv(paths[name])
    return paths


def union_tabs(tabs: Mapping[str, DataFrame]) -> DataFrame:
    """All tabs as text cells in one table; missing columns are empty."""
    check_tabs(tabs)
    frames = [tabularize(tabs[name]).withColumn("tab", F.lit(name)) for name in REQUIRED_TABS if name in tabs]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.na.fill("")


# Sheet requests -----------------------------------------------------------------


def missing_tabs(existing: Collection[str]) -> list[str]:
    return [tab for tab in REQUIRED_TABS if tab not in set(existing)]


def add_sheet_requests(existing: Collection[str]) -> dict | None:
    missing = missing_tabs(existing)
    return {"requests": [{"addSheet": {"properties": {"title": tab}}} for tab in missing]} if missing else None


def clear_request() -> dict:
    return {"ranges": [f"'{tab}'" for tab in REQUIRED_TABS]}


def value_ranges(tab: str, rows: DataFrame, cells: str, order: str, rows_per_request: int = 5000) -> DataFrame:
    """JSON value ranges of a tab, each with at most ``rows_per_request`` rows.

    The header is row 1 and data rows follow in order. A range is a bounded
    batch, so a tab of any size is sent in parts by the tasks that hold them.
    """
    check_tabs([tab])
    headers = headers_of(rows, cells, order)
    spark = rows.sparkSession
    shown = [headers or [EMPTY_HEADER]]
    head = spark.createDataFrame([(0, f"'{tab}'!A1", shown)], "batch long, range string, values array<array<string>>")
    if headers:
        numbered = running(matrix(rows, cells, order, headers), [], [order], sums={"_n": F.lit(1).cast("long")})
        batches = (
            numbered.withColumn("batch", F.floor((F.col("_n") - 1) / rows_per_request) + 1)
            .groupBy("batch")
            .agg(F.min("_n").alias("_from"), F.array_sort(F.collect_list(F.struct("_n", "values"))).alias("_rows"))
        )
        head = head.unionByName(
            batches.select(
                "batch",
                F.concat(F.lit(f"'{tab}'!A"), (F.col("_from") + 1).cast("string")).alias("range"),
                F.transform("_rows", lambda r: r["values"]).alias("values"),
            )
        )
    body = F.struct("range", F.lit("ROWS").alias("majorDimension"), "values")
    return head.select("batch", F.to_json(body).alias("request"))
