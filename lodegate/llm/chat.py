"""Chat formatting in budgeted, turn-aligned windows.

A conversation's turns are in the order of turn, role, text. Prefix sums of turn tokens choose
the windows, markers and escapes included: what the system turn and ``history`` leave of ``budget`` is a conversation's room,
turns that begin in the same stretch of that many tokens share a window, and if they exceed it the
last of them, which alone can, has its own. A window shows the conversation's system turn again,
then as much history as fits ``history`` tokens and the budget, whole turns only, then its own
turns. A window exceeds the budget only where the system turn and one turn do, or the system turn
leaves less than an eighth of it, which is the least room. Own assistant turns are the loss
targets; repeated turns are never targets.

Template: `<turn ROLE>\\n` TEXT `\\n</turn>\\n`. In roles and texts a backslash, `<`, `>` and `#`
get a backslash before them, so no text can hold a marker and reading back is exact.

Prefix sums are counted by blocks: rows are ranged by conversation and order, summed inside a
block, and a conversation that spans blocks adds the sums of its earlier blocks, of which there
is at most one row per block. So a conversation may be of any length.

Defined cases: a null text or role is empty; a null turn sorts first; equal rows are turns of
their own; a turn longer than the room has a window of its own, uncut; rows without a
conversation id are one conversation whose id is null; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegate.llm.context import materialize, prepare
from lodegate.llm.tokens import default_path, encoder

BUDGET, HISTORY = 1024, 256
LEAST_ROOM = 8  # the least part of the budget that own turns get is one in so many
_ESCAPED = r"([\\<>#])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\<>#])", "$1")


_TAIL = "\n</turn>\n"


def _head(role: Column) -> Column:
    return F.concat(F.lit("<turn "), escape(role), F.lit(">\n"))


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            counts = [ids.size for ids in coder.encode(batch.column("block").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], [*batch.schema.names[:-1], "tokens"])

    return run


def turns_with_offsets(rows: DataFrame, path: str) -> DataFrame:
    """Turns with ``before``, the tokens of the conversation's earlier turns, the row's order, and the
    tokens of the system turn that the conversation begins with, if it does."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["conv_id", "turn", "role", "text"]
    shown = F.concat(_head(F.col("role")), escape(F.col("text")), F.lit(_TAIL)).alias("block")
    counted = rows.select(*keys, shown).mapInArrow(_counter(path), "conv_id long, turn long, role string, text string, tokens long")
    counted = materialize(counted, "turns")
    ranged = counted.repartitionByRange(parts, *keys).withColumn("block", F.spark_partition_id())
    ranged = materialize(ranged, "blocks")
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumn("until", F.sum("tokens").over(inside)).withColumn("nth", F.count(F.lit(1)).over(inside))
    lead = F.when(F.col("role") == "system", F.col("tokens")).otherwise(0)
    summed = summed.withColumn("lead", F.first(lead).over(inside))
    totals = summed.groupBy("conv_id", "block").agg(F.sum("tokens").alias("all"), F.count(F.lit(1)).alias("n"), F.max("lead").alias("lead"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("conv_id", "block", F.sum("all").over(earlier).alias("shift"), F.sum("n").over(earlier).alias("skip"), F.first("lead").over(earlier).alias("first"))
    # Only a conversation that goes on from an earlier block has a shift: one per block at most.
    shifts = shifts.filter("shift IS NOT NULL").select(F.col("conv_id").alias("of"), F.col("block").alias("at"), "shift", "skip", "first")
    joined = summed.join(F.broadcast(shifts), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")), "left")
    shift, skip = F.coalesce("shift", F.lit(0)), F.coalesce("skip", F.lit(0))
    return joined.select(
        "conv_id", "role", "text", "tokens",
        (F.col("until") - F.col("tokens") + shift).alias("before"),
        (F.col("nth") + skip).alias("nth"),
        F.coalesce("first", "lead").alias("system_tokens"),
    )


def windows(
    conversations: DataFrame,
    *,
    budget: int = BUDGET,
    history: int = HISTORY,
    path: str | None = None,
    columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
) -> DataFrame:
    """conv_id, window, formatted text, n_repeated turns at its front, and the loss spans.

    Spans are (start, length) in code points of the formatted text.
    """
    if not 0 <= history <= budget:
        raise ValueError("history must be between 0 and the budget")
    prepare(conversations.sparkSession)
    conv, turn, role, text = (F.col(f"`{name}`") for name in columns)
    rows = conversations.select(
        conv.cast("long").alias("conv_id"), turn.cast("long").alias("turn"),
        F.coalesce(role.cast("string"), F.lit("")).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
    )
    given = turns_with_offsets(rows, path or default_path())
    room = F.greatest(F.lit(max(1, budget // LEAST_ROOM)), budget - history - F.col("system_tokens"))
    stretch = F.floor(F.col("before") / room)
    late = F.col("before") + F.col("tokens") > (stretch + 1) * room
    first_in_stretch = F.col("before") - stretch * room
    given = given.withColumn("stretch", stretch).withColumn("late", late & (first_in_stretch > 0))
    # Turns of a stretch but the late one sum to the room at most; the late one moves on if
    # with them it is more, and stays if it is alone there.
    given = materialize(given.withColumn("window", 2 * F.col("stretch") + F.col("late").cast("int")), "placed")

    left = budget - F.max("system_tokens") - F.sum("tokens")
    spans = given.groupBy("conv_id", "window").agg(
        F.min("before").alias("start"), F.min("nth").alias("first"), F.least(F.lit(history), left).alias("repeats")
    )
    spans = materialize(spans, "windows")
    known = spans.select(F.col("conv_id").alias("of"), F.col("window").alias("to"), "start", "first", "repeats")
    # Where a turn is repeated is found without its text: a window begins within ``history`` of
    # the turn's start at most so many half stretches later.
    reach = 2 * F.ceil(history / room) + 2
    ahead = given.filter("role <> 'system' OR nth > 1").select(
        "conv_id", "nth", "before", F.explode(F.sequence(F.col("window") + 1, F.col("window") + reach)).alias("window")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("window") == F.col("to"))
    shown_in = ahead.join(known, same).filter(F.col("start") - F.col("before") <= F.col("repeats"))
    shown_in = materialize(shown_in.select(F.col("conv_id").alias("of"), F.col("nth").alias("at"), F.col("window").alias("to")), "repeats")
    parts = lambda again: F.struct("nth", "role", "text", F.lit(again).alias("again")).alias("part")
    own = given.select("conv_id", "window", parts(False))
    turn_of = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("nth") == F.col("at"))
    past = given.select("conv_id", "nth", "role", "text").join(shown_in, turn_of).select("conv_id", F.col("to").alias("window"), parts(True))
    systems = given.filter("role = 'system' AND nth = 1").select(
        F.col("conv_id").alias("whose"), parts(True)
    )
    kept = known.filter("first > 1").join(systems, F.col("of").eqNullSafe(F.col("whose"))).select(
        F.col("of").alias("conv_id"), F.col("to").alias("window"), "part"
    )
    gathered = own.unionByName(past).unionByName(kept)
    # A window holds budget and history tokens, a system turn and, of longer turns, one.
    gathered = gathered.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    head = lambda p: _head(p["role"])
    shown = gathered.withColumn("shown", F.transform("parts", lambda p: F.struct(
        F.concat(head(p), escape(p["text"]), F.lit(_TAIL)).alias("block"),
        F.length(head(p)).alias("lead"), F.length(escape(p["text"])).alias("size"),
        (~p["again"] & (p["role"] == "assistant")).alias("loss"),
    )))
    spans_of = F.aggregate(
        "shown",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["block"])).alias("at"),
            F.when(s["loss"], F.array_append(acc["spans"], F.struct((acc["at"] + s["lead"]).alias("start"), s["size"].alias("length"))))
            .otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return shown.select(
        "conv_id", "window",
        F.array_join(F.col("shown.block"), "").alias("formatted"),
        F.size(F.filter("parts", lambda p: p["again"])).alias("n_repeated"),
        spans_of.alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The new turns of each window, and the texts under its loss mask, from its formatted text."""
    marker = r"(?s)<turn (.*?(?<!\\)(?:\\\\)*)>\n(.*?)\n</turn>\n"
    roles = F.regexp_extract_all("formatted", F.lit(marker), F.lit(1))
    bodies = F.regexp_extract_all("formatted", F.lit(marker), F.lit(2))
    turns = F.transform(F.arrays_zip(roles.alias("role"), bodies.alias("text")), lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")))
    new = F.slice("turns", F.col("n_repeated") + 1, F.size("turns"))
    return formatted.withColumn("turns", turns).select(
        "conv_id", "window", F.when(F.size("turns") > 0, new).otherwise(F.col("turns")).alias("turns"),
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))).alias("targets"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation out of windows in order; keeps hashes, not texts."""
    key, state, open_ = None, None, False
    out: list[tuple] = []

    def close() -> None:
        if open_:
            out.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    for batch in batches:
        for row in batch.to_pylist():
            if not open_ or row["conv_id"] != key:
                close()
                key, state, open_ = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
            for turn in row["turns"]:
                state[0] += 1
                state[1].update(f"{turn['role']}\n{turn['text']}\n".encode())
            for target in row["targets"]:
                state[2] += len(target)
                state[3].update(target.encode())
            state[4] += row["formatted_chars"]
    close()
    columns = list(zip(*out)) or [[]] * 6
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(columns, kinds)],
        ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    )


def digests(read: DataFrame) -> DataFrame:
    """Counts and SHA-256 per conversation; windows stream through one hash in their order."""
    parts = int(read.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = read.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(
        _digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
