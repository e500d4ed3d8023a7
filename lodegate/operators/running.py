"""Running maxima and sums along an order, safe for keys that hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegate.scale import lookup_join
from lodegate.session import materialize


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    maxima: dict[str, Column] | None = None,
    sums: dict[str, Column] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add inclusive running values per key.

    Rows are range partitioned by key and order, so a large key is cut into
    slices of similar size. Each slice is scanned on its own; one total per
    slice carries the value over from the slices before it. The slices are
    written down first because their limits must not change between the two uses.
    """
    maxima, sums = maxima or {}, sums or {}
    count = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = materialize(
        df.withColumns({**maxima, **sums})
        .repartitionByRange(count, *keys, *order)
        .withColumn("_slice", F.spark_partition_id()),
        "running",
    )
    inside = (
        Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_slice").agg(
        *[F.max(name).alias(name) for name in maxima], *[F.sum(name).alias(name) for name in sums]
    )
    carried = totals.select(
        *keys,
        "_slice",
        *[F.max(name).over(before).alias(f"_before_{name}") for name in maxima],
        *[F.sum(name).over(before).alias(f"_before_{name}") for name in sums],
    )
    scanned = cut.withColumns(
        {name: F.max(name).over(inside) for name in maxima} | {name: F.sum(name).over(inside) for name in sums}
    )
    joined = lookup_join(scanned, carried, [*keys, "_slice"], "left", spread=F.col(order[-1]))
    combined = {name: F.greatest(name, f"_before_{name}") for name in maxima} | {
        name: F.col(name) + F.coalesce(F.col(f"_before_{name}"), F.lit(0)) for name in sums
    }
    return joined.withColumns(combined).drop("_slice", *[f"_before_{name}" for name in (*maxima, *sums)])
