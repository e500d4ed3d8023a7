"""WARC archives: writing captures, reading records back, and assembling transactions.

A capture is three records: a request and a metadata record, each concurrent to the response or
revisit record that holds the payload. Archives are written by Spark's text writer: a record ends
with CR LF CR LF, of which the writer adds the last LF, so any Hadoop path works. They are
compressed as whole files of a bounded number of records. Reading cuts text at the record marker,
so memory is one record; where a payload holds the marker itself, the declared length tells, and
the pieces are put together again. A record that stays short of its length is an error.

Assembly joins request, metadata and response records by their concurrent-to identifiers and
revisits to the responses they refer to, into one nested row per capture.

Defined cases: a null payload is empty; a null id or address has no field; every row is a capture
of its own, also where page ids repeat or are null and where rows are equal throughout; rows
without an id and payloads below ``min_bytes`` are never revisits; a capture without a request or metadata has null there; an
archive folder without records gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodegate.llm.context import materialize, prepare
from lodegate.scale import lookup_join
from lodegate.session import scratch_path

VERSION = "WARC/1.1"
_MARKER = b"\r\n\r\nWARC/1."
MIN_BYTES = 100
RECORDS_PER_FILE = 30_000
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def _name() -> Column:
    """A digest of a row's page id, address and payload digest, null told from empty."""
    url = F.coalesce(F.concat(F.lit("1"), F.col("url")), F.lit("0"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return F.sha2(F.concat_ws("|", page, F.sha2(F.col("html").cast("binary"), 256), url).cast("binary"), 256)


def _record_id(kind: str, name: str = "name", number: Column | None = None) -> Column:
    """A name-based UUID of a row, its number among equal rows and the kind of record."""
    number = F.lit("0") if number is None else number.cast("string")
    h = F.md5(F.concat(F.lit(f"{kind}:"), F.col(name), F.lit(":"), number).cast("binary"))
    cuts = [(1, 8), (9, 4), (14, 3), (18, 3), (21, 12)]
    a, b, c, d, e = (F.substring(h, at, size) for at, size in cuts)
    return F.concat(F.lit("<urn:uuid:"), a, F.lit("-"), b, F.lit("-3"), c, F.lit("-8"), d, F.lit("-"), e, F.lit(">"))


def _numbered(given: DataFrame, repeats: DataFrame) -> DataFrame:
    """The rows that occur more than once, each with a number that is fixed by a table; one of equal rows has 0."""
    rows = given.join(repeats, "name", "left_semi").withColumn("number", F.monotonically_increasing_id() + 1)
    rows = materialize(rows, "repeated")
    leads = materialize(rows.groupBy("name").agg(F.min("number").alias("number")).select("number", F.lit(True).alias("lead")), "leads")
    return rows.join(leads, "number", "left").withColumn("number", F.when(F.col("lead"), 0).otherwise(F.col("number"))).drop("lead")


def _record(kind: str | Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    head = [F.lit(f"{VERSION}\r\nWARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind, F.lit(f"\r\nWARC-Date: {_DATE}\r\n")]
    lines = [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in fields]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(*head, *lines, size, block, F.lit("\r\n\r"))


def _plain(value: Column) -> Column:
    """A field value on one line: control characters and white space runs percent-encoded."""
    return F.regexp_replace(value, r"[\x00-\x20\x7f]+", "%20")


def capture_records(pages: DataFrame, *, page: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """The text of three records per page; equal payloads are revisits of the smallest page's.

    Copies are found on digests alone; rows that repeat as a whole are numbered in a table of their own.
    """
    given = pages.select(
        F.col(f"`{page}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"),
    )
    given = given.withColumn("name", _name())
    digests = given.select("page_id", "name", F.sha2(F.col("html").cast("binary"), 256).alias("digest"), F.octet_length("html").alias("size"))
    digests = materialize(digests, "digests")
    repeats = materialize(digests.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"), "repeats")
    large = digests.filter(F.col("size") >= min_bytes).filter("page_id IS NOT NULL")
    firsts = large.groupBy("digest").agg(F.min(F.struct("page_id", "name")).alias("first"), F.max("page_id").alias("last"))
    firsts = materialize(firsts.filter("first.page_id < last").select("digest", F.col("first.page_id").alias("page"), F.col("first.name").alias("first")), "firsts")
    copies = large.join(firsts, "digest").filter("page_id <> page").select("name", "first").distinct()
    if repeats.isEmpty():
        rows = given.withColumn("number", F.lit(0).cast("long"))
    else:
        rows = given.join(repeats, "name", "left_anti").withColumn("number", F.lit(0).cast("long")).unionByName(_numbered(given, repeats))
    joined = rows.join(materialize(copies, "copies"), "name", "left")
    revisit = F.col("first").isNotNull()
    digest = F.concat(F.lit("sha256:"), F.sha2(F.col("html").cast("binary"), 256))
    size = F.octet_length("html").cast("string")
    body = F.concat(F.lit(_HTTP), size, F.lit("\r\n\r\n"), F.when(revisit, F.lit("")).otherwise(F.col("html")))
    response_id, request_id, metadata_id = (_record_id(kind, number=F.col("number")) for kind in ("response", "request", "metadata"))
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-z]+://([^/\s]+)", 1)
    target = ("WARC-Target-URI", _plain(F.col("url")))
    capture = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        [
            ("WARC-Record-ID", response_id), target, ("WARC-Payload-Digest", digest),
            ("WARC-Refers-To", F.when(revisit, _record_id("response", "first"))),
            ("WARC-Profile", F.when(revisit, F.lit(REVISIT))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        body,
    )
    request = _record(
        "request",
        [("WARC-Record-ID", request_id), ("WARC-Concurrent-To", response_id), target, ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(_plain(F.col("url")), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")),
    )
    metadata = _record(
        "metadata",
        [("WARC-Record-ID", metadata_id), ("WARC-Concurrent-To", response_id), target, ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")), F.lit("payload-bytes: "), size, F.lit("\r\n")),
    )
    return joined.select(F.explode(F.array(request, capture, metadata)).alias("value"))


def write_archives(records: DataFrame, path: str, *, records_per_file: int = RECORDS_PER_FILE) -> None:
    writer = records.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
    writer.text(path)


_RECORD = (
    "record_type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
    "payload_digest string, content_type string, block binary"
)
_FIELDS = {
    "warc-type": "record_type", "warc-record-id": "record_id", "warc-concurrent-to": "concurrent_to", "warc-refers-to": "refers_to",
    "warc-target-uri": "target_uri", "warc-date": "date", "warc-payload-digest": "payload_digest", "content-type": "content_type",
}
_NAMES = [part.split()[0] for part in _RECORD.split(", ")]


def _parse(head: bytes) -> tuple[dict[str, str], int]:
    fields: dict[str, str] = {}
    length = -1
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        name, value = name.strip().lower().decode("ascii", "replace"), value.strip().decode("utf-8", "replace")
        if name == "content-length":
            length = int(value)
        elif name in _FIELDS:
            fields.setdefault(_FIELDS[name], value)
    return fields, length


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[bytes] | None = None  # pieces of a record that is not whole yet
    source = None
    for batch in batches:
        columns: dict[str, list] = {name: [] for name in _NAMES}
        for piece, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held is not None and file != source:
                raise ValueError(f"{source}: the last record ends before its Content-Length")
            held, source = [*(held or []), piece], file
            whole = _MARKER.join(held)
            head, _, block = whole.partition(b"\r\n\r\n")
            fields, length = _parse(head)
            if length < 0:
                raise ValueError(f"{file}: a record has no Content-Length")
            if len(block) < length:
                continue
            held = None
            for name in _NAMES[:-1]:
                columns[name].append(fields.get(name))
            columns["block"].append(block[:length])
        types = [pa.string()] * (len(_NAMES) - 1) + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[name], kind) for name, kind in zip(_NAMES, types)], _NAMES)
    if held is not None:
        raise ValueError(f"{source}: the last record ends before its Content-Length")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``, compressed or not, version 1.0 or 1.1.

    Uncompressed archives are cut into splits at markers; a payload with a marker that falls on a
    split is refused, not misread. Compressed ones are one split each.
    """
    prepare(spark)
    lines = spark.read.option("lineSep", _MARKER.decode()).text(path)
    return lines.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file")).mapInArrow(_records, _RECORD)


def _http_payload() -> Column:
    return F.expr("CASE WHEN content_type LIKE 'application/http%' THEN substring(block, position(x'0d0a0d0a', block) + 4) ELSE block END")


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its request and metadata.

    Archives are read once, into a table with a folder per kind of record, so that a side of the
    joins reads its own records alone.
    """
    spark = records.sparkSession
    path = scratch_path(spark, "records")
    records.write.partitionBy("record_type").parquet(path)
    records = spark.read.schema(records.schema).parquet(path)
    head = records.filter("record_type IN ('response', 'revisit')").select(
        "record_id", "record_type", "target_uri", "date", "payload_digest", F.col("refers_to").alias("refers_to_id"),
        _http_payload().alias("payload"),
    )
    head = head.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    head = head.withColumn("payload_sha256", F.sha2("payload", 256))
    beside = lambda kind: records.filter(F.col("record_type") == kind).select(
        F.col("concurrent_to").alias("record_id"), F.struct("record_id", "content_type", F.col("block").cast("string").alias("text")).alias(kind)
    )
    return head.join(beside("request"), "record_id", "left").join(beside("metadata"), "record_id", "left")


def field(name: str, text: Column) -> Column:
    """A field of an application/warc-fields text, or null."""
    found = F.regexp_extract(text, rf"(?:^|\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def resolved(captured: DataFrame) -> DataFrame:
    """Captures by page, revisits with the size and digest of the payload that they repeat.

    page_id, payload_bytes, payload_digest, record_type, refers_to (a page_id).
    """
    rows = captured.select(
        "record_id", "record_type", "refers_to_id", "payload_bytes", "payload_sha256", "payload_digest",
        field("page-id", F.col("metadata.text")).cast("long").alias("page_id"),
    )
    rows = materialize(rows, "captures")
    first = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("bytes"), F.col("payload_sha256").alias("sha256"),
    )
    # Most rows refer to nothing and need no join; of the others one response may have most.
    revisits = lookup_join(rows.filter("refers_to_id IS NOT NULL"), first, ["refers_to_id"], "left", spread=F.col("record_id"))
    joined = rows.filter("refers_to_id IS NULL").unionByName(revisits, allowMissingColumns=True)
    return joined.select(
        "page_id", F.coalesce("bytes", "payload_bytes").alias("payload_bytes"), F.coalesce("sha256", "payload_sha256").alias("payload_digest"),
        "record_type", "refers_to",
    )
