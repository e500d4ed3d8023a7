"""Landed responses as a Spark data source and sink, ``format("landed")``.

Under ``path`` a body is one file, ``bodies/source/yyyy/mm/dd/hash.ext``, named by its content, so
a repeated task or run finds it there and writes nothing. What is known about a response is one
row of a Parquet file per task. A run publishes all its files by renaming their folder to
``responses/run=N``; a run that fails deletes the folder and leaves at most bodies that no row names.

Reading has one input partition per file of rows, and equality on source_id, raw_document_id,
canonical_url and storage_key reaches those files before any body is opened. With the option
``bodies`` set to false there is no body column and no body is opened. A stream reads the runs in
the order they were published; its offset is the number of a run. The option ``run`` reads one run.

Defined cases: no run yet gives no rows; a run without rows publishes nothing; a row whose body or
storage key is null is refused; a body that is gone is an error; equal rows are rows of their own.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)

COLUMNS = (
    "raw_document_id string, source_id string, original_url string, canonical_url string, content_hash string, "
    "retrieved_at timestamp, status_code int, headers map<string,string>, storage_key string, content_type string"
)
FILTERED = ("source_id", "raw_document_id", "canonical_url", "storage_key")
READ_ROWS = 1024
READ_BYTES = 8 << 20  # bodies handed over at once, or one body if it is larger


def _files(path: str) -> tuple[fs.FileSystem, str]:
    local = re.sub(r"^file:/+", "/", path)
    files, root = fs.FileSystem.from_uri(local)
    return files, root.rstrip("/")


def _listed(files: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    return files.get_file_info(fs.FileSelector(folder, allow_not_found=True))


def _runs(files: fs.FileSystem, root: str) -> dict[int, str]:
    """Folders of the published runs by their number."""
    found = {}
    for info in _listed(files, f"{root}/responses"):
        match = re.fullmatch(r"run=(\d+)", info.base_name)
        if match:
            found[int(match[1])] = info.path
    return found


@dataclass
class Responses(InputPartition):
    """A file of rows."""

    file: str


@dataclass
class Written(WriterCommitMessage):
    """The file of rows that a task wrote, or none."""

    file: str | None


class _Bodies:
    """Reads files of rows and joins their bodies to them."""

    def __init__(self, options, schema) -> None:
        self.path = options["path"]
        self.bodies = options.get("bodies", "true").lower() == "true"
        self.run = int(options["run"]) if "run" in options else None
        self.names = [field.name for field in schema.fields if field.name != "body"]
        self.wanted: list[tuple[str, list]] = []

    def partitions(self, first: int = 1, last: int | None = None) -> list[Responses]:
        """The files of the published runs from the first to the last."""
        files, root = _files(self.path)
        runs = [
            folder for run, folder in sorted(_runs(files, root).items())
            if run >= first and (last is None or run <= last) and self.run in (None, run)
        ]
        return [Responses(info.path) for folder in runs for info in _listed(files, folder) if info.base_name.endswith(".parquet")]

    def rows(self, partition: Responses) -> Iterator[pa.RecordBatch]:
        files, root = _files(self.path)
        condition = None
        for name, values in self.wanted:
            term = ds.field(name).isin(values)
            condition = term if condition is None else condition & term
        given = ds.dataset(partition.file, filesystem=files, format="parquet")
        for batch in given.to_batches(columns=self.names, filter=condition, batch_size=READ_ROWS, use_threads=False):
            yield from self._with_bodies(files, root, batch) if self.bodies else [batch]

    def _with_bodies(self, files: fs.FileSystem, root: str, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        start, held, size = 0, [], 0
        for row, key in enumerate(batch.column("storage_key").to_pylist()):
            with files.open_input_stream(f"{root}/bodies/{key}", compression=None) as stream:
                held.append(stream.read())
            size += len(held[-1])
            if size >= READ_BYTES or row + 1 == batch.num_rows:
                part = batch.slice(start, len(held))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], [*part.schema.names, "body"])
                start, held, size = row + 1, [], 0


class LandedReader(DataSourceReader):
    def __init__(self, options, schema) -> None:
        self.source = _Bodies(options, schema)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for condition in filters:
            column = getattr(condition, "attribute", ())
            if isinstance(condition, (EqualTo, In)) and len(column) == 1 and column[0] in FILTERED:
                self.source.wanted.append((column[0], list(condition.value) if isinstance(condition, In) else [condition.value]))
            else:
                yield condition

    def partitions(self) -> list[Responses]:
        # A reader without partitions would be asked to read a default one.
        return self.source.partitions() or [Responses("")]

    def read(self, partition: Responses) -> Iterator[pa.RecordBatch]:
        if partition.file:
            yield from self.source.rows(partition)


class LandedStreamReader(DataSourceStreamReader):
    def __init__(self, options, schema) -> None:
        self.source = _Bodies(options, schema)

    def initialOffset(self) -> dict:
        return {"run": 0}

    def latestOffset(self) -> dict:
        return {"run": max(_runs(*_files(self.source.path)), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Responses]:
        return self.source.partitions(start["run"] + 1, end["run"])

    def read(self, partition: Responses) -> Iterator[pa.RecordBatch]:
        return self.source.rows(partition)


class LandedWriter(DataSourceArrowWriter):
    def __init__(self, path: str) -> None:
        self.path = path
        self.staged = f"_staged/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _files(self.path)
        target, writer = f"{root}/{self.staged}/{uuid.uuid4().hex}.parquet", None
        folders: set[str] = set()
        try:
            for batch in iterator:
                if batch.column("storage_key").null_count or batch.column("body").null_count:
                    raise ValueError("A response needs a storage key and a body")
                for key, body in zip(batch.column("storage_key").to_pylist(), batch.column("body")):
                    if {"", ".", ".."} & set(key.split("/")):
                        raise ValueError(f"{key!r} is no storage key")
                    self._put(files, f"{root}/bodies/{key}", body.as_buffer(), folders)
                known = pa.Table.from_batches([batch]).drop_columns("body")
                if writer is None:
                    files.create_dir(f"{root}/{self.staged}", recursive=True)
                    writer = pq.ParquetWriter(target, known.schema, filesystem=files)
                writer.write_table(known)
        finally:
            if writer is not None:
                writer.close()
        return Written(None if writer is None else target)

    @staticmethod
    def _put(files: fs.FileSystem, target: str, body: pa.Buffer, folders: set[str]) -> None:
        """Write a body unless it is there; it gets its name when it is whole."""
        if files.get_file_info(target).type != fs.FileType.NotFound:
            return
        folder = target.rpartition("/")[0]
        if folder not in folders:
            files.create_dir(folder, recursive=True)
            folders.add(folder)
        part = f"{target}.{uuid.uuid4().hex}"
        with files.open_output_stream(part, compression=None) as stream:
            stream.write(body)
        files.move(part, target)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _files(self.path)
        staged, kept = f"{root}/{self.staged}", {m.file for m in messages if m is not None and m.file}
        if not kept:
            return
        for info in _listed(files, staged):
            if info.path not in kept:  # of an attempt that was lost
                files.delete_file(info.path)
        files.create_dir(f"{root}/responses", recursive=True)
        files.move(staged, f"{root}/responses/run={max(_runs(files, root), default=0) + 1:08d}")

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _files(self.path)
        if files.get_file_info(f"{root}/{self.staged}").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/{self.staged}")


class Landed(DataSource):
    """Landed responses; the module text says how they are kept."""

    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> str:
        return COLUMNS if self.options.get("bodies", "true").lower() == "false" else f"{COLUMNS}, body binary"

    def reader(self, schema) -> LandedReader:
        return LandedReader(self.options, schema)

    def streamReader(self, schema) -> LandedStreamReader:
        return LandedStreamReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> LandedWriter:
        if overwrite:
            raise ValueError("Landed responses are evidence and only appended to")
        return LandedWriter(self.options["path"])


def register(spark: SparkSession) -> SparkSession:
    """Make ``format("landed")`` known to the session, with its filters pushed down."""
    spark.dataSource.register(Landed)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def land(documents: DataFrame, path: str) -> None:
    """Append responses (the rows of ``storage.raw_documents``) as one run; no body is shuffled."""
    spark = register(documents.sparkSession)
    names = [column.split()[0] for column in COLUMNS.split(", ")]
    # A batch of whole bodies is bounded by bytes and not by rows alone.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(READ_BYTES))
    documents.select(*names, "body").write.format("landed").mode("append").save(path)


def landed(spark: SparkSession, path: str, *, bodies: bool = True, run: int | None = None) -> DataFrame:
    reader = register(spark).read.format("landed").option("bodies", str(bodies).lower())
    return (reader if run is None else reader.option("run", run)).load(path)


def landed_stream(spark: SparkSession, path: str, *, bodies: bool = True) -> DataFrame:
    return register(spark).readStream.format("landed").option("bodies", str(bodies).lower()).load(path)
