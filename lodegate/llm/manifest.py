"""A Merkle manifest of a table of documents, and proofs of all leaves by octopus multiproofs.

Every document is a leaf. Per language, leaves ascend by doc_id and every 8 consecutive nodes become
one, until one node, the subroot, remains; subroots, by language, become the root in the same way.

A leaf partition is a run of 8^4 leaves of one language. It knows the digests of its leaves, works
out the coordinates of the nodes that the proofs of all of them need beside what it can derive
(``missing``: the union over its leaves, each node once), fetches those in one join, derives the
shared interior nodes, and expands the proof of each leaf on its own. Above the partitions, levels are
groups of 8 nodes, so their work falls by 8 from level to level. A node of level L is asked for by
7 * 8^(L-4) partitions at most; it stands in 8^(L-6) copies, so no key of the join has more than
448 partitions. Leaves are ranked by a range partition over narrow rows, however many a language has.

Defined cases: null fields count as ``-``; a null doc_id comes before others, a null language before
others; rows of one doc_id ascend by their leaf, and equal rows stand side by side (their proofs may
differ by the place); a language of one document has its leaf as subroot, a table of one language
its subroot as root; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lodegate.llm.context import materialize, prepare

ARITY = 8
PARTITION_LEVELS = 4
_SPREAD_LEVEL = 6
_HEX = 64
_ROW_BITS = 33  # of monotonically_increasing_id, below the partition's number


def node_digest(children: bytes) -> bytes:
    return hashlib.sha256(children).hexdigest().encode()


def height(size: int) -> int:
    """Levels above ``size`` leaves until one node remains."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def missing(known: Iterable[int], size: int, levels: int) -> list[tuple[int, int]]:
    """(level, place) of the nodes that the proofs of the ``known`` leaves need and can't derive.

    At each level the runs that hold a known node need the rest of their members; then the nodes
    above those runs are known. ``levels`` bounds how far up the tree is followed.
    """
    out, places = [], sorted(set(known))
    for level in range(levels):
        held, above = set(places), sorted({place // ARITY for place in places})
        for run in above:
            members = range(run * ARITY, min(size, run * ARITY + ARITY))
            out += [(level, place) for place in members if place not in held]
        places, size = above, -(-size // ARITY)
    return out


# --- Leaves and their places -------------------------------------------------------------------


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[_field(fields[name]) for name in _FIELDS]), 256)


def leaves(docs: DataFrame, offered: Callable[[dict[str, Column]], dict[str, Column]] | None = None) -> DataFrame:
    """doc_id, tree (the language, '' for null, else after '='), leaf, and the leaf of what is ``offered`` for proof."""
    fields = {name: F.col(f"`{name}`") for name in _FIELDS}
    tree = F.coalesce(F.concat(F.lit("="), fields["lang"]), F.lit(""))
    shown = leaf(offered(fields)) if offered else leaf(fields)
    return docs.select(fields["doc_id"].cast("long").alias("doc_id"), tree.alias("tree"), leaf(fields).alias("leaf"), shown.alias("offered"))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Adds place (from 0 within its tree) and size (rows of its tree).

    Rows are dealt by ranges of (tree, order), with a number against very many equal rows, and
    written in order; a row's place is its number in the file plus the rows that its tree has in
    earlier ranges. That count has one row per range and tree; joined on both, no key is larger
    than a range.
    """
    number = F.monotonically_increasing_id()
    sorted_ = rows.withColumn("tie", number).repartitionByRange("tree", *order, "tie").sortWithinPartitions("tree", *order, "tie").drop("tie")
    ranged = materialize(sorted_.withColumns({"range": F.spark_partition_id(), "row": number.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}), "ranged")
    parts = ranged.groupBy("tree", "range").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = "sum(rows) OVER (PARTITION BY tree ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    starts = parts.select("tree", "range", F.expr(f"coalesce({earlier}, 0) - first").alias("start"), F.expr("sum(rows) OVER (PARTITION BY tree)").alias("size"))
    joined = ranged.join(materialize(starts, "starts"), ["tree", "range"])
    return joined.select(*rows.columns, (F.col("row") + F.col("start")).alias("place"), "size")


# --- Leaf partitions ---------------------------------------------------------------------------

_PARTITION = (
    "tree string, part long, size long, node string, keys array<string>, leaves binary, offered binary, missing array<struct<level: int, place: long>>"
)


def _levels(digests: bytes, levels: int) -> list[bytes]:
    """The digests of each level, one after another, from the leaves up."""
    out = [digests]
    for _ in range(levels):
        below, width = out[-1], _HEX * ARITY
        out.append(b"".join(node_digest(below[at : at + width]) for at in range(0, len(below), width)))
    return out


def _gather(table: pa.Table) -> pa.Table:
    order = np.argsort(table["place"].to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    size, first = table["size"][0].as_py(), table["place"][0].as_py()
    digests, shown = ("".join(table[name].to_pylist()).encode() for name in ("leaf", "offered"))
    own = min(PARTITION_LEVELS, height(size))
    wanted = missing(range(first, first + len(table)), size, height(size))
    # All of them lie above the partition: its runs are whole, as it begins at a multiple of 8^4.
    return pa.table(
        {
            "tree": table["tree"][:1], "part": table["part"][:1], "size": table["size"][:1],
            "node": [_levels(digests, own)[-1].decode()], "keys": [table["key"].to_pylist()], "leaves": pa.array([digests], pa.binary()),
            "offered": pa.array([shown], pa.binary()), "missing": pa.array([[{"level": l, "place": p} for l, p in wanted]], pa.list_(pa.struct([("level", pa.int32()), ("place", pa.int64())]))),
        }
    ).cast(_partition_schema())


def _partition_schema() -> pa.Schema:
    return pa.schema([
        ("tree", pa.string()), ("part", pa.int64()), ("size", pa.int64()), ("node", pa.string()), ("keys", pa.list_(pa.string())), ("leaves", pa.binary()),
        ("offered", pa.binary()), ("missing", pa.list_(pa.struct([("level", pa.int32()), ("place", pa.int64())]))),
    ])


def partitions(rows: DataFrame) -> DataFrame:
    """One row per leaf partition of placed ``rows`` (tree, place, size, key, leaf, offered)."""
    part = F.shiftright("place", 3 * PARTITION_LEVELS).alias("part")
    dealt = rows.select("tree", part, "place", "size", "key", "leaf", "offered")
    return materialize(dealt.groupBy("tree", "part").applyInArrow(_gather, _PARTITION), "leaf-partitions")


def nodes_above(parts: DataFrame) -> DataFrame:
    """Digests (tree, level, place, size, digest) of the partitions' own nodes and of all above them."""
    own = F.least(F.lit(PARTITION_LEVELS), _height(F.col("size")))
    level = materialize(parts.select("tree", own.alias("level"), F.col("part").alias("place"), "size", F.col("node").alias("digest")), "nodes")
    out = level
    largest = parts.agg(F.max("size")).first()[0] or 0
    for at in range(PARTITION_LEVELS, height(largest)):
        members = F.array_sort(F.collect_list(F.struct("place", "digest")))  # 8 at most
        text = F.array_join(F.transform(members, lambda m: m["digest"]), "")
        whole = level.filter(F.col("size") > ARITY**at)
        above = whole.groupBy("tree", F.shiftright("place", 3).alias("place"), "size").agg(F.sha2(text, 256).alias("digest"))
        level = materialize(above.select("tree", F.lit(at + 1).alias("level"), "place", "size", "digest"), "nodes")
        out = out.unionByName(level)
    return out


def _height(size: Column) -> Column:
    """Levels above ``size`` leaves, exact for every long."""
    return F.size(F.filter(F.array(*[F.lit(ARITY**k) for k in range(21)]), lambda full: full < size))


def _copies(level: Column) -> Column:
    return F.pow(F.lit(ARITY), F.greatest(level - _SPREAD_LEVEL, F.lit(0))).cast("long")


def fetched(parts: DataFrame, answers: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """Leaf partitions with the digests they asked for.

    ``every`` has a text for each tree that all its partitions get, as the node (height, -1).
    """
    wanted = F.col("missing")
    if every is not None:
        top = F.struct(_height(F.col("size")).alias("level"), F.lit(-1).cast("long").alias("place"))
        wanted = F.concat(wanted, F.array(top))
        answers = answers.select("tree", "level", "place", "digest").unionByName(every.select("tree", "level", F.lit(-1).cast("long").alias("place"), "digest"))
    copy = F.pmod(F.xxhash64("part"), _copies(F.col("level"))).alias("copy")
    asked = parts.select("tree", "part", F.inline(wanted)).select("tree", "part", "level", "place", copy)
    copies = F.sequence(F.lit(0).cast("long"), _copies(F.col("level")) - 1)
    held = answers.select("tree", "level", "place", "digest", F.explode(copies).alias("copy"))
    met = asked.join(held, ["tree", "level", "place", "copy"])
    # 7 nodes a level at most.
    lists = met.groupBy("tree", "part").agg(F.collect_list(F.struct("level", "place", "digest")).alias("nodes"))
    return parts.drop("missing").join(materialize(lists, "fetched"), ["tree", "part"], "left")


class Partition:
    """The proofs of one leaf partition, from its leaves and the fetched nodes."""

    def __init__(self, part: int, size: int, leaves: bytes, nodes: list[dict] | None) -> None:
        top = height(size)
        own = min(PARTITION_LEVELS, top)
        given = {(n["level"], n["place"]): n["digest"] for n in nodes or ()}
        self.every = given.pop((top, -1), None)
        self.levels = _levels(leaves, own)
        # Above the partition: what stands beside the only node of the way up, and that node.
        self.beside: list[tuple[bytes, bytes]] = []
        node, place, left = self.levels[-1], part, -(-size // ARITY**own)
        for level in range(own, top):
            run = range(place // ARITY * ARITY, min(left, place // ARITY * ARITY + ARITY))
            before, after = ("".join(given[level, p] for p in run if (p < place) == is_before and p != place).encode() for is_before in (True, False))
            self.beside.append((before, after))
            node, place, left = node_digest(before + node + after), place // ARITY, -(-left // ARITY)
        self.subroot = node

    def siblings(self, level: int, at: int) -> tuple[bytes, bytes]:
        """Digests before and after the ancestor at ``level`` of the ``at``-th leaf, within its run."""
        own = len(self.levels) - 1
        if level >= own:
            return self.beside[level - own]
        place = at >> (3 * level)
        first, data = place // ARITY * ARITY * _HEX, self.levels[level]
        return data[first : place * _HEX], data[(place + 1) * _HEX : first + ARITY * _HEX]

    def path(self, at: int) -> list[tuple[bytes, bytes]]:
        return [self.siblings(level, at) for level in range(len(self.levels) - 1 + len(self.beside))]


def fold(leaf_digest: bytes, path: Iterable[tuple[bytes, bytes]]) -> bytes:
    for before, after in path:
        leaf_digest = node_digest(before + leaf_digest + after)
    return leaf_digest


def _path_text(path: Iterable[tuple[bytes, bytes]]) -> str:
    return ";".join(f"{before.decode()},{after.decode()}" for before, after in path)


def _path_of(text: str) -> list[tuple[bytes, bytes]]:
    return [tuple(side.encode() for side in level.split(",")) for level in text.split(";") if level]


def _tree_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the tree of subroots: each subroot's tree, the root, and the path to it."""
    for batch in batches:
        for part, size, keys, digests, nodes in zip(*(batch.column(k).to_pylist() for k in range(5))):
            held = Partition(part, size, digests, nodes)
            paths = [f"{held.subroot.decode()};{_path_text(held.path(at))}" for at in range(len(keys))]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(paths, pa.string())], names=["tree", "digest"])


_PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_NAMES = [field.split()[0] for field in _PROOFS.split(", ")]


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, size, keys, digests, nodes, shown in zip(*(batch.column(k).to_pylist() for k in range(6))):
            held = Partition(part, size, digests, nodes)
            root, _, text = held.every.partition(";")
            over = _path_of(text)
            own = len(held.levels) - 1
            # Proofs share all but their lowest level: the rest of each is built once per node of level 1.
            rest = {}
            upper = b"".join(before + after for before, after in held.beside + over)
            refolded = fold(held.subroot, over).decode()
            rows = []
            for at, key in enumerate(keys):
                true, offered = digests[at * _HEX : at * _HEX + _HEX], shown[at * _HEX : at * _HEX + _HEX]
                if at >> 3 not in rest:
                    rest[at >> 3] = b"".join(b"".join(held.siblings(level, at)) for level in range(1, own)) + upper
                lowest = b"".join(held.siblings(0, at)) if own else b""
                # The leaf as it was derives what the partition derived; another one goes all the way alone.
                folded = refolded if offered == true else fold(offered, held.path(at) + over).decode()
                proof = node_digest(lowest + rest[at >> 3]).decode()
                rows.append((None if key == "" else int(key), true.decode(), held.subroot.decode(), root, proof, folded, folded == root))
            columns = list(zip(*rows))
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES)


def proofs(docs: DataFrame, offered: Callable[[dict[str, Column]], dict[str, Column]] | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what is ``offered`` in its place held against the root.

    ``offered`` maps the columns of a document to those that are shown to the verifier.
    """
    prepare(docs.sparkSession)
    rows = placed(materialize(leaves(docs, offered), "leaves"), "doc_id", "leaf")
    parts = partitions(rows.withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    nodes = nodes_above(parts)
    subroots = nodes.filter(F.col("level") == _height(F.col("size"))).select("tree", "level", "digest")
    # The same once more over the subroots, as leaves of one tree in the order of their languages.
    over = placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("digest").alias("leaf"), F.col("digest").alias("offered")), "key")
    top = partitions(over)
    ways = fetched(top, nodes_above(top)).select("part", "size", "keys", "leaves", "nodes").mapInArrow(_tree_paths, "tree string, digest string")
    every = materialize(subroots.select("tree", "level").join(ways, "tree"), "ways")
    asked = fetched(parts, nodes, every).select("part", "size", "keys", "leaves", "nodes", "offered")
    return asked.mapInArrow(_expanded, _PROOFS)


def tampered(fields: dict[str, Column]) -> dict[str, Column]:
    """Where 3 divides the CRC-32 of the decimal doc_id, the text with A-Z in lower case."""
    lowered = F.translate(fields["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(fields["doc_id"].cast("string")) % 3 == 0
    return {**fields, "text": F.when(hit, lowered).otherwise(fields["text"])}
