"""Text cells for tabular exports."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T


@F.pandas_udf(T.StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """JSON with sorted keys, spaces after separators and ASCII escapes."""
    return text.map(lambda value: json.dumps(json.loads(value), sort_keys=True), na_action="ignore")


def cell(column: Column, data_type: T.DataType) -> Column:
    """One value as an export cell: empty for null, sorted JSON for nested values."""
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        text = canonical_json(F.to_json(column, {"ignoreNullFields": "false"}))
    elif isinstance(data_type, T.VariantType):
        text = _variant_cell(column)
    elif isinstance(data_type, T.BooleanType):
        text = F.initcap(column.cast("string"))
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        text = _float_text(column)
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(""))


@F.pandas_udf(T.StringType())
def _float_text(values: pd.Series) -> pd.Series:
    return values.map(lambda value: repr(float(value)), na_action="ignore")


def _variant_cell(value: Column) -> Column:
    shape = F.schema_of_variant(value)
    nested = shape.startswith("OBJECT") | shape.startswith("ARRAY")
    flat = F.when(shape == "BOOLEAN", F.initcap(value.cast("string"))).otherwise(value.cast("string"))
    return F.when(nested, canonical_json(F.when(nested, F.to_json(value)))).otherwise(flat)


def tabularize(records: DataFrame) -> DataFrame:
    """Every top-level field of every record as a text cell."""
    return records.select(*[cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in records.schema.fields])
