"""Join and grouping building blocks that stay safe when keys are skewed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot when it holds more than this share of the rows, so at most
# HOT_KEY_LIMIT keys can be hot whatever the table size. A hot key is cut into
# parts of at most that share, which makes at most twice as many parts in all.
HOT_KEY_LIMIT = 1024
BROADCAST_BYTES = 8 * 1024 * 1024
SPREAD_BYTES = 8 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for the optimized plan of ``df``."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def input_bytes(df: DataFrame) -> int:
    """Size of what ``df`` reads: the sum over the leaves of its plan, whatever is joined above them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(at).stats().sizeInBytes()) for at in range(leaves.size()))


def parallel(df: DataFrame) -> DataFrame:
    """Spread rows that would be read by fewer tasks than there are cores.

    For work that costs far more per row than moving the row. Nothing is run to decide: a plan
    that reads at most ``SPREAD_BYTES`` per core is dealt anew, larger inputs come in enough
    partitions and stay where they are, as do streams.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or input_bytes(df) > cores * SPREAD_BYTES:
        return df
    return df.repartition(cores)


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = HOT_KEY_LIMIT) -> DataFrame:
    """Keys holding more than 1/limit of the rows, and into how many parts (``_salts``) each is cut."""
    counts = df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    salts = F.ceil(F.col("_rows") * limit / total).cast("long").alias("_salts")
    return counts.filter(F.col("_rows") * limit > total).select(*keys, salts)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    spread: Column,
    limit: int = HOT_KEY_LIMIT,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join that splits hot left keys by their share of the rows.

    ``right`` holds at most a few rows per key. Rows of a hot key on the left
    are spread by ``spread`` over as many salts as the key needs; the matching
    right rows are repeated once per salt. Other keys are shuffled once. Works for inner, left, left_semi and
    left_anti because every left row meets every right row of its key.
    The keys are counted in ``counted`` where that is given: a cheaper table that holds those of the left rows.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"skew_join does not support {how!r}")
    hot = F.broadcast(hot_keys(left if counted is None else counted, keys, limit))
    # Null keys match nothing, so any salt does; without one they would meet in one task.
    keyless = F.exists(F.array(*[F.col(key).isNull() for key in keys]), lambda absent: absent)
    parts = F.when(keyless, F.lit(limit).cast("long")).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = left.join(hot, list(keys), "left").withColumn("_salt", F.pmod(F.xxhash64(spread), parts)).drop("_salts")
    salted_right = right.join(hot, list(keys), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_salts")
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    spread: Column,
    max_bytes: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join a fact table to a lookup: broadcast when small, salted shuffle when not."""
    if estimated_bytes(right) <= max_bytes:
        return left.join(F.broadcast(right), list(keys), how)
    return skew_join(left, right, keys, how, spread=spread, counted=counted)


def first_per_key(df: DataFrame, keys: Sequence[str], order: str, *, wide: bool = False) -> DataFrame:
    """The row with the smallest ``order`` per key; ``order`` must be unique.

    The minimum is combined on the map side, so no task ever holds the rows of
    one key. Narrow rows travel inside the minimum, in one pass. For ``wide``
    rows only the order is compared, and the winners are joined back on it.
    """
    if wide:
        winners = df.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
        return df.join(winners, [order], "left_semi")
    others = [c for c in df.columns if c not in keys and c != order]
    first = df.groupBy(*keys).agg(F.min(F.struct(order, *others)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)
