"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodegate.llm.context import materialize

REMAINDER = 10_000


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest node reached from each node of a small graph."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    yield pa.RecordBatch.from_arrays([pa.array(list(parent), pa.int64()), pa.array([find(x) for x in parent], pa.int64())], ["u", "p"])


def components(edges: DataFrame, remainder: int = REMAINDER) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    A round contracts the graph: each node goes to the first, in an order of the round, among
    itself and its neighbours that lead it, and edges go to what their ends went to. In the first
    round ``a`` leads ``b``, so stars around leads are done at once; later rounds order nodes by a
    fresh hash, which leaves a constant share of them on average, so rounds grow with the logarithm
    of the nodes. What is left of at most ``remainder`` edges is closed in one go. All other steps are joins and map-side minima over written tables; no edge comes
    to the driver. A self edge (a, a) adds a node without a neighbour.
    """
    labels, turn = None, 0
    edges = edges.select("a", "b")
    while True:
        rank = F.struct(F.xxhash64(F.col("a"), F.lit(turn)).alias("h") if turn else F.lit(0).alias("h"), F.col("a").alias("p"))
        led = edges.select(F.col("b").alias("u"), rank.alias("r")).unionByName(edges.select(F.col("a").alias("u"), rank.alias("r")))
        parents = materialize(led.groupBy("u").agg(F.min("r").alias("r")).select("u", F.col("r.p").alias("p")), "parents")
        labels = _moved(labels, parents)
        of_a = parents.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        of_b = parents.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        left = edges.join(of_a, "a").join(of_b, "b").filter("pa <> pb").select("pa", "pb")
        turn += 1
        first, second = F.xxhash64(F.col("pa"), F.lit(turn)), F.xxhash64(F.col("pb"), F.lit(turn))
        leads = (first < second) | ((first == second) & (F.col("pa") < F.col("pb")))
        left = left.select(F.when(leads, F.col("pa")).otherwise(F.col("pb")).alias("a"), F.when(leads, F.col("pb")).otherwise(F.col("pa")).alias("b"))
        edges = materialize(left.distinct(), "contracted")
        left = edges.count()
        if left <= remainder:
            if left:
                labels = _moved(labels, materialize(edges.repartition(1).mapInArrow(_close, "u long, p long"), "closed"))
            break
    names = labels.groupBy("label").agg(F.min("node").alias("component"))
    return materialize(labels.join(names, "label").select("node", "component"), "components")


def _moved(labels: DataFrame | None, parents: DataFrame) -> DataFrame:
    if labels is None:
        return parents.select(F.col("u").alias("node"), F.col("p").alias("label"))
    moved = labels.join(parents.select(F.col("u").alias("label"), "p"), "label", "left")
    return materialize(moved.select("node", F.coalesce("p", "label").alias("label")), "labels")
