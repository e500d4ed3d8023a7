"""Session settings and durable storage shared by every job."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Results depend on these two: timestamps are UTC and later map keys win.
_SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# These only shape the physical plan.
_PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in {**_SEMANTICS, **_PLANNING}.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers of the session's application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lodegate-package-")) / "lodegate.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for module in sorted(package.rglob("*.py")):
            bundle.write(module, module.relative_to(package.parent).as_posix())
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def build_session(
    app_name: str = "lodegate",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    # Capturing a call site per column costs more than building the plan itself.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named by spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder of this machine.
    """
    active = spark.sparkContext.getCheckpointDir()
    if active is not None:
        return active
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="lodegate-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Scratch:
    """Remembers the tables written in its ``with`` block, by this thread, and removes them when told to."""

    def __init__(self) -> None:
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        self._outer, _active.scratch = getattr(_active, "scratch", None), self
        return self

    def __exit__(self, *_: object) -> None:
        _active.scratch = self._outer

    def add(self, path: str) -> None:
        self._paths.append(path)

    def remove(self, spark: SparkSession) -> None:
        while self._paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop())
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_active = threading.local()


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing the rows once to the shared folder and reading them back.

    The files outlive lost executors, and later plans see their real size. Hashes written as text make
    much of them, which only a codec with entropy coding halves.
    """
    path = scratch_path(df.sparkSession, label)
    scratch = getattr(_active, "scratch", None)
    if scratch is not None:
        scratch.add(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
