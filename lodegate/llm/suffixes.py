"""Removal of byte strings that repeat across or inside texts, by two-stage suffix sorting.

A byte goes if some string of ``size`` bytes that covers it also starts at another place of the
corpus. Starts of such strings are looked for in three steps.

Cutting: a string belongs to the smallest hash among its ``GRAM``-byte grams. Neighbouring starts
with one smallest gram are a stretch; equal strings have equal smallest grams, so only stretches
of one gram can repeat each other, and a stretch whose gram occurs once repeats nothing. Stretches
equal as a whole fold into one with a count; those that occur twice or more are settled.

Sorting: the different stretches of a gram, of which each is a witness and those that occur once
are open, meet in a task. Their suffixes are sorted in two stages. Suffixes smaller than their
successor are sorted directly, to the depth of ``size`` bytes; scanning the buckets of first bytes
from the smallest on, each suffix induces the place of the one before it if that is larger than
its successor. Common prefixes of neighbours in the order of at least ``size`` bytes mark repeats.
A gram of very many stretches, as at the ends of a very common passage, is split over salts in
proportion to their number; then each salt hands its different strings on once, as two 64-bit
hashes in lists by ranges of the hash, as many more ranges as salts, and strings of one range that
come from two salts repeat as well.

Removing: the runs of starts are joined per text, and the bytes they cover are cut.

Defined cases: a null text is empty; texts under ``size`` bytes lose nothing and match nothing;
equal texts of at least that size lose everything, the first included; an id may be given several
times, each row has its own result; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodegate.llm.arrays import Texts, chunks, mix, powers, prefix_hash
from lodegate.llm.context import materialize, prepare, texts

SIZE = 400
GRAM = 128
GROUP = 2048  # stretches of one gram that are sorted together
SORT_BYTES = 1 << 20
SORT_KEYS = 1 << 13  # suffixes whose bytes are held beside the text to compare them
_BLOCK = 1 << 18
_PLACE = np.uint64((1 << 22) - 1)


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row, by running minima of blocks from both sides."""
    count = values.size - width + 1
    padded = np.full(-(-values.size // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: values.size] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def stretches(part: Texts, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first start, number of starts, hash of the smallest gram, hash of all its bytes)."""
    out: list[tuple[np.ndarray, ...]] = []
    data = part.data
    low = 0
    while low + size <= data.size:
        block = data[low : low + _BLOCK + size - 1]
        sums = prefix_hash(block)
        _, down = powers(sums.size)
        grams = mix((sums[gram:] - sums[:-gram]) * down[: block.size - gram + 1])
        places = np.arange(grams.size, dtype=np.uint64)
        smallest = _window_minima((grams & ~_PLACE) | places, size - gram + 1)
        at = (smallest & _PLACE).astype(np.int64)
        starts = np.arange(at.size) + low
        owner = np.searchsorted(part.offsets, starts, "right") - 1
        whole = starts + size <= part.offsets[owner + 1]
        starts, owner, at = starts[whole], owner[whole], at[whole]
        if starts.size:
            new = np.ones(starts.size, dtype=bool)
            new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, starts.size))
            s = starts[first] - low
            e = s + count - 1 + size
            out.append((owner[first], starts[first] - part.offsets[owner[first]], count, grams[at[first]], mix((sums[e] - sums[s]) * down[s])))
        low += _BLOCK
    if not out:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    return tuple(np.concatenate(column) for column in zip(*out))


def _cut(size: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in chunks(batch.column(1)):
                owner, first, count, key, whole = stretches(part, size, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high].take(pa.array(owner)), pa.array(first), pa.array(count),
                        pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)),
                    ],
                    ["tid", "first", "count", "gram", "whole"],
                )

    return run


def _by_comparison(text: bytes, places: np.ndarray, depth: int, keys: int) -> np.ndarray:
    """The suffixes at these places in the order of their first ``depth`` bytes, ties in any order.

    They are dealt out by eight bytes at a time until at most ``keys`` are left together, or
    some that agree in all ``depth`` bytes; only those have their bytes copied to be compared.
    """
    heads = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text + bytes(8), dtype=np.uint8), 8)

    def refine(places: np.ndarray, at: int) -> None:
        """In place, and without arrays of its own while it goes deeper."""
        if places.size <= keys:
            places[:] = sorted(places.tolist(), key=lambda p: text[p : p + depth])
            return
        if at >= depth:  # equal, or a shorter one at the end of the text followed by zeros in the others
            places[:] = places[np.argsort(np.minimum(len(text) - places, depth), kind="stable")]
            return
        head = heads[np.minimum(places + at, len(text))].view(">u8").reshape(-1).astype(np.uint64)
        order = np.argsort(head, kind="stable")
        places[:], head = places[order], head[order]
        begins = np.flatnonzero(np.append(True, head[1:] != head[:-1]))
        ends = np.append(begins[1:], places.size)
        del head, order
        low = 0
        while low < begins.size:
            high = max(low + 1, int(np.searchsorted(ends, begins[low] + keys, "right")))
            refine(places[begins[low] : ends[high - 1]], at if high > low + 1 else at + 8)
            low = high

    places = places.copy()
    refine(places, 0)
    return places


def suffix_order(text: bytes, depth: int, keys: int = SORT_KEYS) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes at least, ties in any order.

    Two-stage sorting: suffixes smaller than their successor are sorted by comparison, the others
    are induced from left to right, a whole bucket or wave of it at a time.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    n = data.size
    # A suffix compares to its successor as its first byte to the next different one.
    differs = np.append(data[1:] != data[:-1], True)
    change = np.flatnonzero(differs)
    run = np.searchsorted(change, np.arange(n))
    at = change[run]
    smaller = np.zeros(n, dtype=bool)
    inner = at + 1 < n
    smaller[inner] = data[at[inner]] < data[at[inner] + 1]
    direct = _by_comparison(text, np.flatnonzero(smaller), depth, keys)
    direct_ends = np.searchsorted(data[direct], np.arange(257))
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and not smaller[n - 1]:
        larger[data[n - 1]].append(np.array([n - 1]))  # its successor is the empty suffix
    order: list[np.ndarray] = []

    def induce(bucket: int, placed: np.ndarray) -> np.ndarray:
        """Give the larger suffixes before these their places; those of the same bucket come back."""
        before = placed[placed > 0] - 1
        before = before[~smaller[before]]
        if not before.size:
            return before
        byte = data[before]
        by_byte = np.argsort(byte, kind="stable")
        before, byte = before[by_byte], byte[by_byte]
        cuts = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
        same = before[:0]
        for a, b in zip(cuts, np.append(cuts[1:], byte.size)):
            if byte[a] == bucket:
                same = before[a:b]
            else:
                larger[byte[a]].append(before[a:b])
        return same

    for bucket in range(256):
        wave = np.concatenate(larger[bucket]) if larger[bucket] else np.zeros(0, dtype=np.int64)
        while wave.size:
            order.append(wave)
            wave = induce(bucket, wave)
        placed = direct[direct_ends[bucket] : direct_ends[bucket + 1]]
        order.append(placed)
        induce(bucket, placed)
    return np.concatenate(order)


def repeated_starts(strings: list[bytes], counts: list[int], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """For all starts of all strings, in order: is it repeated, is it the first of its equals.

    Also the position of each start in the joined text, and that text.
    """
    text = b"".join(strings)
    begins = np.concatenate([[0], np.cumsum([len(s) for s in strings])])[:-1]
    many = np.array(counts, dtype=np.int64)
    starts = np.repeat(begins, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    wanted = np.zeros(len(text), dtype=bool)
    wanted[starts] = True
    order = suffix_order(text, size)
    order = order[wanted[order]]
    # Common prefixes of neighbours, eight bytes at a time.
    padded = np.frombuffer(text + bytes(8), dtype=np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view(np.uint64).reshape(-1)
    pairs = np.arange(order.size - 1)
    for k in (*range(0, size - 7, 8), *([size - 8] if size % 8 else [])):
        pairs = pairs[words[order[pairs] + k] == words[order[pairs + 1] + k]]
    repeated = np.zeros(len(text), dtype=bool)
    repeated[order[pairs]] = True
    repeated[order[pairs + 1]] = True
    leads = np.zeros(len(text), dtype=bool)
    leads[order] = True
    leads[order[pairs + 1]] = False
    return repeated[starts], leads[starts], starts, text


_RUNS = "tid binary, first long, count long"
_LISTS = "gram long, shelf long, print_a array<long>, print_b array<long>, tids array<binary>, firsts array<long>"
_RUNS_SCHEMA = [("tid", pa.binary()), ("first", pa.int64()), ("count", pa.int64())]
_LISTS_SCHEMA = [
    ("gram", pa.int64()), ("shelf", pa.int64()), ("print_a", pa.list_(pa.int64())), ("print_b", pa.list_(pa.int64())),
    ("tids", pa.list_(pa.binary())), ("firsts", pa.list_(pa.int64())),
]
SHELVES = 8  # ranges of the hash per salt


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


def _sort(size: int):
    """Runs of repeated starts inside groups of stretches, and the lists of the salts of split grams.

    A listed string has a text and a start if its stretch occurs once and it did not repeat here.
    """

    def settle(rows: list[dict]) -> list[dict]:
        repeated, leads, starts, text = repeated_starts([r["body"] for r in rows], [r["count"] for r in rows], size)
        out: list[dict] = []
        prints: list[tuple] = []
        at = 0
        for row in rows:
            mine = slice(at, at + row["count"])
            at += row["count"]
            if row["n"] == 1:
                out += [{"tid": row["tid"], "first": row["first"] + int(f), "count": int(c)} for f, c in zip(*_runs(repeated[mine]))]
            if row["salts"] > 1:
                own = np.flatnonzero(leads[mine])
                asks = (row["n"] == 1) & ~repeated[mine][own]
                prints.append((starts[mine][own], row["first"] + own, [row["tid"] if ask else None for ask in asks]))
        if prints:
            data = np.frombuffer(text, dtype=np.uint8)
            place, first, tids = np.concatenate([p[0] for p in prints]), np.concatenate([p[1] for p in prints]), sum((p[2] for p in prints), [])
            _, down = powers(data.size + 1)
            two = [mix((sums[place + size] - sums[place]) * down[place]) for sums in (prefix_hash(data), prefix_hash(data ^ 0xA5))]
            shelf = (two[0] % np.uint64(SHELVES * rows[0]["salts"])).astype(np.int64)
            order = np.argsort(shelf, kind="stable")
            cuts = np.flatnonzero(np.append(True, shelf[order][1:] != shelf[order][:-1]))
            for low, high in zip(cuts, np.append(cuts[1:], order.size)):
                part = order[low:high]
                out.append({
                    "gram": rows[0]["gram"], "shelf": int(shelf[part[0]]), "print_a": two[0][part].view(np.int64), "print_b": two[1][part].view(np.int64),
                    "tids": [tids[k] for k in part], "firsts": first[part],
                })
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        group: list[dict] = []
        weight = 0

        def emit(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(settle(rows), schema=pa.schema(_RUNS_SCHEMA + _LISTS_SCHEMA))

        for batch in batches:
            for row in batch.to_pylist():
                if group and (row["gram"], row["salt"]) != (group[0]["gram"], group[0]["salt"]):
                    if held and (weight > SORT_BYTES or group[0]["salts"] > 1):
                        yield emit(held)
                        held, weight = [], 0
                    held += group
                    weight += sum(len(r["body"]) for r in group)
                    if group[0]["salts"] > 1:
                        yield emit(held)
                        held, weight = [], 0
                    group = []
                group.append(row)
        for rows in ([held, group] if held and group and group[0]["salts"] > 1 else [held + group]):
            if rows:
                yield emit(rows)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Listed strings that come from two salts; the lists of a shelf follow each other."""
    held: list[dict] = []

    def settle() -> pa.RecordBatch:
        a, b = (np.concatenate([np.array(r[name], dtype=np.int64) for r in held]) for name in ("print_a", "print_b"))
        tids, firsts = sum((r["tids"] for r in held), []), sum((r["firsts"] for r in held), [])
        order = np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        hit = np.zeros(a.size, dtype=bool)
        hit[order[1:][same]] = hit[order[:-1][same]] = True
        rows = [{"tid": tids[k], "first": firsts[k], "count": 1} for k in np.flatnonzero(hit) if tids[k] is not None]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(_RUNS_SCHEMA))

    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["gram"], row["shelf"]) != (held[0]["gram"], held[0]["shelf"]):
                yield settle()
                held = []
            held.append(row)
    if held:
        yield settle()


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted stretch of a text."""
    for batch in batches:
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            raw = text.encode()
            rows = [{**w, "body": raw[w["first"] : w["first"] + w["bytes"]]} for w in wanted]
            for at in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_pylist(rows[at : at + 2000], schema=_BODY_SCHEMA)


_BODY_SCHEMA = pa.schema([
    ("gram", pa.int64()), ("salt", pa.int64()), ("salts", pa.int64()), ("n", pa.int64()),
    ("tid", pa.binary()), ("first", pa.int64()), ("count", pa.int64()), ("body", pa.binary()),
])
_BODY = "gram long, salt long, salts long, n long, tid binary, first long, count long, body binary"


def cover(first: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal byte runs under strings that begin in the given runs of starts."""
    order = np.argsort(first, kind="stable")
    low, high = first[order], (first + count - 1 + size)[order]
    top = np.maximum.accumulate(high)
    new = np.append(True, low[1:] > top[:-1])
    at = np.flatnonzero(new)
    return low[at], np.maximum.reduceat(high, at)


def _remove(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tid, text, runs in zip(*(batch.column(name).to_pylist() for name in ("tid", "text", "runs"))):
                raw = text.encode()
                low, high = cover(np.array([r["first"] for r in runs]), np.array([r["count"] for r in runs]), size)
                kept = b"".join(raw[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), len(raw)]))
                spans = [{"start": a, "stop": b} for a, b in zip(low.tolist(), high.tolist())]
                rows.append({"tid": tid, "spans": spans, "kept": kept})
            yield pa.RecordBatch.from_pylist(rows, schema=_CUT_SCHEMA)

    return run


_CUT_SCHEMA = pa.schema([("tid", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())])
_CUT = "tid binary, spans array<struct<start:long,stop:long>>, kept binary"


def repeated_runs(given: DataFrame, size: int = SIZE, gram: int = GRAM, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """Runs of starts (tid, first, count) whose strings repeat, and one text of each tid in them.

    ``given`` has doc_id, tid and text; a tid stands for one text.
    """
    cut = materialize(given.select("tid", "text").mapInArrow(_cut(size, gram), f"{_RUNS}, gram long, whole long"), "stretches")
    often = materialize(cut.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("gram"), "grams")
    cut = materialize(cut.join(often, "gram", "left_semi"), "candidates")
    same = ["gram", "whole", "count"]
    folded = cut.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("tid", "first")).alias("at"))
    folded = materialize(folded.select(*same, "n", "at.*"), "folded")
    settled = cut.join(folded.filter("n > 1").select(*same), same, "left_semi").select("tid", "first", "count").distinct()
    settled = materialize(settled, "settled")
    several = folded.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).filter("k > 1 AND least = 1")
    several = materialize(several.select("gram", F.ceil(F.col("k") / group).alias("salts")), "several")
    open_ = folded.join(several, "gram").select(
        "gram", F.pmod("whole", "salts").alias("salt"), "salts", "n", "tid", "first", "count", (F.col("count") + size - 1).alias("bytes")
    )
    open_ = materialize(open_, "open")

    needed = materialize(open_.select("tid").union(settled.select("tid")).distinct(), "needed")
    none = F.lit(-(1 << 63)).cast("long")
    picked = given.select("tid", F.coalesce("doc_id", none).alias("pick")).groupBy("tid").agg(F.min("pick").alias("pick"))
    picked = materialize(picked.join(needed, "tid", "left_semi"), "picked")
    chosen = given.withColumn("pick", F.coalesce("doc_id", none)).join(picked, ["tid", "pick"], "left_semi")
    bodies = materialize(chosen.select("tid", "text"), "bodies")

    wanted = open_.groupBy("tid").agg(F.collect_list(F.struct("gram", "salt", "salts", "n", "tid", "first", "count", "bytes")).alias("wanted"))
    parts = int(given.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strings = bodies.join(wanted, "tid").mapInArrow(_bodies, _BODY).repartition(parts, "gram", "salt").sortWithinPartitions("gram", "salt")
    sorted_ = materialize(strings.mapInArrow(_sort(size), f"{_RUNS}, {_LISTS}"), "sorted")
    found = sorted_.filter("tid IS NOT NULL").select("tid", "first", "count")
    listed = sorted_.filter("shelf IS NOT NULL").select("gram", "shelf", "print_a", "print_b", "tids", "firsts")
    across = listed.repartition(parts, "gram", "shelf").sortWithinPartitions("gram", "shelf").mapInArrow(_meet, _RUNS)
    return settled.unionByName(found).unionByName(across), bodies


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", *, size: int = SIZE, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, the removed spans, the kept bytes (the whole text where nothing is removed) and their digest."""
    prepare(docs.sparkSession)
    given = texts(docs, key, text).withColumn("tid", F.unhex(F.md5(F.col("text").cast("binary"))))
    runs, bodies = repeated_runs(given, size, gram, group)
    per_text = runs.groupBy("tid").agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    removed = materialize(bodies.join(per_text, "tid").mapInArrow(_remove(size), _CUT).dropDuplicates(["tid"]), "removed")
    whole = F.col("text").cast("binary")
    cut = given.join(removed, "tid", "left").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.coalesce("spans", F.array().cast("array<struct<start:long,stop:long>>")).alias("spans"), F.coalesce("kept", whole).alias("kept"),
    )
    return cut.withColumn("kept_sha256", F.sha2("kept", 256))
