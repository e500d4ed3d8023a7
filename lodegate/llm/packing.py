"""Packing of documents into token sequences, shortest pack first over the length histogram.

A document is its token ids and an end id. Whole runs of ``size`` ids fill a sequence each; what
is left is a piece of 1 to ``size`` ids. The histogram of piece lengths, ``size`` numbers whatever
the data, comes to the driver. Lengths are placed longest first, each into the pack patterns with
the most room, and a pattern is split when only some of its packs take a piece; a pattern is a
number of equal packs, so the work depends on ``size`` alone. Pieces then find their place by
their rank among pieces of their length. Ranks are counts inside an input partition plus the
counts of earlier partitions, so no task holds the pieces of one length.

Defined cases: a null or empty text is its end id alone; equal documents are packed one by one;
a null id stays null; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lodegate.llm.arrays import chunks
from lodegate.llm.context import materialize, prepare, texts
from lodegate.llm.tokens import default_path, encoder

SIZE = 1024
END_ID = 0
_NARROW = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, rank long"


def _cut(path: str, size: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size + 1, dtype=np.int64)
        task = TaskContext.get().partitionId()
        coder = encoder(path)
        for batch in batches:
            for low, high, _ in chunks(batch.column(1)):
                keys = batch.column(0)[low:high].to_pylist()
                columns: dict[str, list] = defaultdict(list)
                for key, ids in zip(keys, coder.encode(batch.column(1)[low:high].to_pylist())):
                    ids = np.append(ids, np.uint32(end_id))
                    raw = memoryview(ids.astype("<u4").tobytes())
                    for start in range(0, ids.size, size):
                        length = min(size, ids.size - start)
                        columns["doc_id"].append(key)
                        columns["start"].append(start)
                        columns["length"].append(length)
                        columns["ids_crc32"].append(zlib.crc32(raw[4 * start : 4 * (start + length)]))
                        columns["doc_tokens"].append(ids.size)
                        columns["part"].append(task)
                        columns["rank"].append(int(seen[length]))
                        if with_ids:
                            columns["ids"].append(ids[start : start + length])
                        seen[length] += 1
                types = [pa.int64()] * 5 + [pa.int32(), pa.int64()] + [pa.list_(pa.int64())] * with_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(columns.values(), types)], list(columns)
                )

    return run


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", *, path: str | None = None, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with their rank among the same length of their partition."""
    schema = _NARROW + ", ids array<long>" * with_ids
    return texts(docs, key, text).mapInArrow(_cut(path or default_path(), size, end_id, with_ids), schema)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packs as (how many, lengths in order) for a histogram of lengths from 1 to ``size``."""
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in by_room.items() if packs), default=0)
            if room < length:
                by_room[size - length].append((left, (length,)))
                break
            count, lengths = by_room[room].pop()
            used = min(count, left)
            if count > used:
                by_room[room].append((count - used, lengths))
            by_room[room - length].append((used, (*lengths, length)))
            left -= used
    return [pack for packs in by_room.values() for pack in packs]


def _places(packs: list[tuple[int, tuple[int, ...]]]) -> tuple[np.ndarray, ...]:
    """Runs of ranks of a length that go to consecutive sequences at one offset."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, lengths in packs:
        offset = 0
        for length in lengths:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    return tuple(np.array(column, dtype=np.int64) for column in zip(*sorted(rows)))


def _place(places: tuple[np.ndarray, ...]):
    length_of, first, sequence, offset = places
    spread = np.int64(1) << np.int64(48)
    keys = length_of * spread + first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            at = np.searchsorted(keys, length * spread + rank, "right") - 1
            kept = [name for name in batch.schema.names if name not in ("part", "rank", "before")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(name)) for name in kept), pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])],
                [*kept, "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", *, path: str | None = None, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces with their sequence and their place in it."""
    prepare(docs.sparkSession)
    cut = materialize(pieces(docs, key, text, path=path, size=size, end_id=end_id, with_ids=with_ids), "pieces")
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition and length.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.select("*", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "counts")
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = cut.join(counts.drop("n"), ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * with_ids + ", sequence_id long, offset long"
    names = [part.split()[0] for part in out.split(", ")]
    ranked = ranked.select(*names[:-2], "rank")
    if not histogram:
        return ranked.select(*names[:-2], F.col("rank").alias("sequence_id"), F.col("rank").alias("offset"))
    return ranked.mapInArrow(_place(_places(shortest_pack_first(histogram, size))), out)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids, and each piece's document and length, in order; needs ids."""
    part = F.struct("offset", "doc_id", "start", "length", "ids")
    grouped = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return grouped.select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["length"].alias("length"))).alias("pieces"),
    )
