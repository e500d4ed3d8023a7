"""State of a stream as a few merged runs of batches, cut into buckets by key.

The runs that cover the first n batches are those of the binary digits of n: 13 batches are the
runs 0-7, 8-11 and 12. A batch that completes a power of two writes its keys merged with the runs
it completes, so all batches together write each key once per doubling, a batch reads at most
log2(n) + 1 runs, and of them only the buckets its own keys fall into. Which runs a batch reads
and writes follows from its number alone: a batch that is run again replaces its own run and finds
what it read before, since the runs it merged go when the next batch begins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

Merge = Callable[[DataFrame], DataFrame]


def runs_of(batches: int) -> list[tuple[int, int]]:
    """(first, last) batch of the runs that cover ``batches`` batches, from the oldest on."""
    out, at = [], 0
    for bit in reversed(range(batches.bit_length())):
        if batches >> bit & 1:
            out.append((at, at + (1 << bit) - 1))
            at += 1 << bit
    return out


@dataclass(frozen=True)
class RunStore:
    """Rows of ``schema``, bucketed by the hash of ``key``; ``merge`` folds rows of several runs."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    merge: Merge
    buckets: int = 16

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _folder(self, run: tuple[int, int]) -> str:
        return f"{self.path.rstrip('/')}/run={run[0]}-{run[1]}"

    def _files(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read(self, runs: list[tuple[int, int]]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        frames = [self.spark.read.schema(schema).parquet(self._folder(run)) for run in runs]
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        return whole

    def before(self, batch: int, keys: DataFrame | None = None) -> DataFrame:
        """Rows of all batches before ``batch``; with ``keys``, of the buckets that these fall into."""
        runs = runs_of(batch)
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        stored = self._read(runs)
        if keys is not None:
            # As many numbers as there are buckets at most; they prune the folders that are read.
            wanted = [row[0] for row in keys.select(self.bucket(F.col(self.key))).distinct().collect()]
            stored = stored.filter(F.col("bucket").isin(wanted))
        return self.merge(stored.drop("bucket"))

    def write(self, rows: DataFrame, batch: int) -> None:
        """Store the rows of a batch, merged with the runs that it completes."""
        old, new = runs_of(batch), runs_of(batch + 1)
        completed = [run for run in old if run not in new]
        fresh = rows.select(*self.schema.fieldNames())
        if completed:
            fresh = fresh.unionByName(self._read(completed).drop("bucket"))
        placed = self.merge(fresh).withColumn("bucket", self.bucket(F.col(self.key)))
        placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._folder(new[-1]))
        self._remove_all_but([*old, new[-1]])

    def _remove_all_but(self, runs: list[tuple[int, int]]) -> None:
        root, files = self._files()
        kept = {self._folder(run).rsplit("/", 1)[1] for run in runs}
        for status in files.listStatus(root):
            if status.getPath().getName() not in kept:
                files.delete(status.getPath(), True)

    def stored_runs(self) -> list[str]:
        root, files = self._files()
        return sorted(s.getPath().getName() for s in files.listStatus(root)) if files.exists(root) else []

    def all(self) -> DataFrame:
        """Rows of all batches stored so far."""
        spans = [tuple(map(int, name.removeprefix("run=").split("-"))) for name in self.stored_runs()]
        last = max((end for _, end in spans), default=-1)
        return self.before(last + 1)
