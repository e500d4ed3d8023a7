"""Near-duplicates by BagMinHash signatures of word shingle multisets.

A text is the multiset of its five-word shingles (`[^\\x20\\x09-\\x0D]+` words, case kept; a text
of one to four words is one shingle). A shingle of weight w is a set of levels (0, w]. Levels are
discretised into dyadic blocks (0,1], (1,2], (2,4], ...; each block of a shingle carries a Poisson
process with the rate of its length, whose points have a time and one of m components. A block
that w cuts is drawn whole, and points above w are thinned out; it is not split further. The
smallest time of each component is the signature: two texts agree in a component with the
probability of their weighted Jaccard similarity. Points are only drawn up to a time by which all
components are expected to be hit; texts with a gap draw further, so the result is as if all were.

Bands of equal components give candidates; every candidate link is settled by exact multiset
overlap, min over max of counts, of at least the threshold, or by a class that already holds both.

Defined cases: null, empty and blank texts have no shingle, are near nothing, and are classes of
their own; equal multisets are one class without verification; an empty table gives an empty one;
an id given with several texts has one row, with the smallest of their classes; each row without an
id has a row of no class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodegate.llm.arrays import Texts, chunks, list_array, mix, stream, string_parts
from lodegate.llm.components import components
from lodegate.llm.context import materialize, prepare, texts

WORDS = 5
BANDS, ROWS = 30, 5
_SIGNATURES = "doc_id long, n long, print_a long, print_b long, bands array<long>"


def _salt(k: int) -> np.uint64:
    return np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1)


def bags(part: Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: their text, hash and count, in order of both."""
    keys, bounds = part.shingles(words)
    owner = np.repeat(np.arange(len(part)), np.diff(bounds))
    order = np.argsort(keys)
    small = owner.astype(np.uint16) if len(part) < 65536 else owner
    order = order[np.argsort(small[order], kind="stable")]
    keys, owner = keys[order], owner[order]
    new = np.ones(keys.size, dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return owner[first], keys[first], np.diff(np.append(first, keys.size))


def _draw(owner: np.ndarray, key: np.ndarray, weight: np.ndarray, until: np.ndarray, signature: np.ndarray) -> None:
    """Lower the components of ``signature`` to the points up to time ``until`` of each text."""
    size = signature.shape[1]
    flat = signature.reshape(-1)
    level, low, length = 0, 0, 1
    rows = np.arange(owner.size)
    while rows.size:
        seed = mix(key[rows] + _salt(level + 1))
        own, top = owner[rows], weight[rows]
        time = np.zeros(rows.size)
        limit = until[own]
        step = 0
        while seed.size:
            draw = mix(seed + _salt(2 * step + 1))
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / length
            on = time <= limit
            seed, own, top, time, limit = seed[on], own[on], top[on], time[on], limit[on]
            where = mix(seed + _salt(2 * step + 2))
            component = ((where >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
            position = low + length * ((where & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32)
            inside = position < top
            at = own[inside] * size + component[inside].astype(np.int64)
            np.minimum.at(flat, at, time[inside])
            step += 1
        low, length = low + length, max(1, 2 * length if low else 1)
        level += 1
        rows = rows[weight[rows] > low]


def signatures(owner: np.ndarray, key: np.ndarray, weight: np.ndarray, count: int, size: int) -> np.ndarray:
    """Smallest times of ``size`` components for each of ``count`` texts."""
    out = np.full((count, size), np.inf)
    mass = np.bincount(owner, weights=weight, minlength=count)
    until = np.where(mass > 0, size * (np.log(size) + 2) / np.maximum(mass, 1), 0)
    open_ = mass > 0
    while open_.any():
        rows = open_[owner]
        _draw(owner[rows], key[rows], weight[rows], until, out)
        open_ &= np.isinf(out).any(axis=1)
        until = np.where(open_, 2 * until, until)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(signature.shape[0], bands, rows)
    keys = np.broadcast_to(stream(99, bands), bits.shape[:2]).copy()
    for k in range(rows):
        keys = mix(keys ^ bits[:, :, k])
    return keys


def _sign(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in chunks(batch.column(1)):
                owner, key, count = bags(part, words)
                n = np.bincount(owner, weights=count, minlength=len(part)).astype(np.int64)
                ends = np.searchsorted(owner, np.arange(len(part) + 1))
                prints = []
                for salt in (3, 5):
                    sums = np.zeros(key.size + 1, dtype=np.uint64)
                    np.cumsum(mix(key + np.uint64(salt)) * count.astype(np.uint64), out=sums[1:])
                    prints.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
                keys = band_keys(signatures(owner, key, count, len(part), bands * rows), bands, rows)
                keys = keys[n > 0].reshape(-1).view(np.int64)
                bounds = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], pa.array(n), pa.array(prints[0]), pa.array(prints[1]), list_array(keys, bounds, pa.int64())],
                    ["doc_id", "n", "print_a", "print_b", "bands"],
                )

    return run


GROUPS = 8  # of shingles by hash, for bounds


def overlap(left: Texts, right: Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the smaller and of the larger counts for each pair of texts; the former by group too."""
    sides = []
    for part in (left, right):
        owner, key, count = bags(part, words)
        tagged = mix(key ^ mix(owner.astype(np.uint64)))
        group = owner * GROUPS + (key % np.uint64(GROUPS)).astype(np.int64)
        sides.append((tagged, group, count, np.bincount(owner, weights=count, minlength=len(part))))
    (a, group, count_a, all_a), (b, _, count_b, all_b) = sides
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    grouped = np.bincount(group[at_a], weights=np.minimum(count_a[at_a], count_b[at_b]), minlength=len(left) * GROUPS)
    grouped = grouped.reshape(len(left), GROUPS)
    common = grouped.sum(axis=1)
    return common, all_a + all_b - common, grouped


_SHARED = [f"shared_{k}" for k in range(GROUPS)]


def _verify(words: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right_data, right_offsets = string_parts(batch.column(3))
            for low, high, left in chunks(batch.column(2)):
                part = right_offsets[low : high + 1]
                right = Texts(right_data[part[0] : part[-1]], part - part[0])
                common, joined, grouped = overlap(left, right, words)
                near = (common >= threshold * joined - 1e-9) & (joined > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], batch.column(1)[low:high], pa.array(near), *(pa.array(c.astype(np.int64)) for c in grouped.T)],
                    ["a", "b", "near", *_SHARED],
                )

    return run


def _overlaps(pairs: DataFrame, bodies: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs (a, b), whether their multisets overlap enough, and the overlap by groups of shingles."""
    left = bodies.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = bodies.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return materialize(both.mapInArrow(_verify(words, threshold), "a long, b long, near boolean, " + ", ".join(f"{c} long" for c in _SHARED)), "overlaps")


def _alone(words: int):
    """Each text's distinct shingles with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in chunks(batch.column(1)):
                owner, key, count = bags(part, words)
                ids = batch.column(0)[low:high].take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([ids, pa.array(key.view(np.int64)), pa.array(count.astype(np.int64))], ["doc_id", "shingle", "n"])

    return run


def near_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    threshold: float = 0.8,
    words: int = WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    leads: int = 512,
) -> DataFrame:
    """(doc_id, class_id): classes of documents linked by near-duplicates, named by the smallest id.

    Texts with equal multisets fold into one before banding, so groups of copies cost one row. In
    each bucket all members first meet one of them, the lead: the one whose buckets hold the most
    members, as an original does among its edited copies. Buckets that still hold several classes
    go on. Two members share at most what the one with less of it shares with the lead, in each of a
    few groups of shingles, and of the rest what the one with less of it shares with any other such
    text; pairs whose similarity is below the threshold even so are no links, without a look. The
    lead itself has met all already. Of the others, members outside the
    bucket's largest class are leads, more of them each round, and meet the members of other
    classes, until a bucket is one class or has no member left to lead. So no candidate link is
    lost, and a bucket of copies costs rows in proportion to its size.
    """
    prepare(docs.sparkSession)
    given = texts(docs, key, text).filter(F.col("doc_id").isNotNull())
    signed = materialize(given.mapInArrow(_sign(words, bands, rows), _SIGNATURES), "signatures")
    prints = ["n", "print_a", "print_b"]
    # Equal multisets have equal bands, so the smallest row has the bands of all.
    firsts = signed.filter("n > 0").groupBy(*prints).agg(F.min(F.struct("doc_id", "bands")).alias("first"))
    firsts = materialize(firsts.select(*prints, "first.*"), "firsts")

    placed = firsts.select("doc_id", "n", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialize(placed.join(materialize(shared, "shared"), "bucket"), "members")
    central = members.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    members = materialize(members.join(central, "doc_id"), "weighed")
    leading = members.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("m"))).alias("lead"))
    members = members.select("bucket", "doc_id", "n").join(leading.select("bucket", (-F.col("lead.m")).alias("lead")), "bucket")
    members = materialize(members, "led")
    bodies = materialize(given.join(materialize(central.select("doc_id"), "wanted"), "doc_id", "left_semi"), "bodies")

    pairs = members.filter("doc_id <> lead").select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).distinct()
    overlaps = _overlaps(pairs, bodies, words, threshold)
    classes = components(overlaps.filter("near"))
    open_ = _mixed(members, classes)
    if not open_.isEmpty():
        texts_ = bodies.join(open_.select("doc_id").distinct(), "doc_id", "left_semi").distinct()
        held = texts_.mapInArrow(_alone(words), "doc_id long, shingle long, n long").groupBy("shingle")
        held = held.agg(F.count(F.lit(1)).alias("texts"), F.min("doc_id").alias("doc_id"), F.min("n").alias("n")).filter("texts = 1")
        own = held.groupBy("doc_id").agg(F.sum("n").alias("own"))
        shared = overlaps.select(F.col("a").alias("lead"), F.col("b").alias("doc_id"), *_SHARED)
        open_ = open_.join(own, "doc_id", "left").join(shared, ["lead", "doc_id"])
        outer = F.greatest(F.col("n") - sum(F.col(c) for c in _SHARED) - F.coalesce("own", F.lit(0)), F.lit(0))
        open_ = materialize(open_.select("bucket", "doc_id", "n", *_SHARED, outer.alias("outer"), "component"), "bounded")
        wanted = leads
        while True:
            sizes = open_.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
            top = sizes.groupBy("bucket").agg(F.max(F.struct("k", "component")).alias("top"), F.sum("k").alias("k"))
            top = top.select("bucket", F.col("top.component").alias("top"), (F.col("k") - F.col("top.k")).alias("others"))
            chance = F.pmod(F.xxhash64("bucket", "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
            lead = open_.join(top, "bucket").filter((F.col("component") != F.col("top")) & (chance * F.col("others") < F.lit(float(wanted))))
            lead = lead.select(
                "bucket", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("outer").alias("outer_a"),
                F.col("component").alias("of"), *(F.col(c).alias(f"{c}_a") for c in _SHARED),
            )
            common = sum((F.least(c, f"{c}_a") for c in _SHARED), F.least("outer", "outer_a"))
            near = (F.col("component") != F.col("of")) & (common + 1e-9 >= threshold * (F.col("n") + F.col("n_a") - common))
            other = open_.select(F.col("bucket").alias("at"), "doc_id", "n", "outer", "component", *_SHARED)
            met = lead.join(other, (F.col("bucket") == F.col("at")) & near)
            met = met.select(F.least("a", "doc_id").alias("a"), F.greatest("a", "doc_id").alias("b")).distinct()
            new = _overlaps(met, bodies, words, threshold).filter("near").select("a", "b")
            if not new.isEmpty():
                stars = classes.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
                classes = components(stars.unionByName(new))
            left = open_.join(top.filter(F.col("others") > wanted).select("bucket"), "bucket", "left_semi")
            left = left.drop("component")
            if left.isEmpty():
                break
            open_, wanted = _mixed(left, classes), 16 * wanted
            if open_.isEmpty():
                break

    # Copies have the class of their first; an id of several texts has the smallest of theirs.
    named = firsts.select(*prints, F.col("doc_id").alias("node")).join(classes, "node", "left")
    named = named.select(*prints, F.coalesce("component", "node").alias("class_id"))
    found = signed.select("doc_id", *prints).join(named, prints, "left")
    found = found.groupBy("doc_id").agg(F.min(F.coalesce("class_id", "doc_id")).alias("class_id"))
    # Rows without an id can't be told apart: each has a row, of no class.
    nameless = texts(docs, key, text).filter("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return found.unionByName(nameless)


def _mixed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of buckets that hold several classes, with their class."""
    named = classes.select(F.col("node").alias("doc_id"), "component")
    named = members.join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    named = materialize(named, "classed")
    mixed = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return materialize(named.join(mixed.select("bucket"), "bucket", "left_semi"), "mixed")
