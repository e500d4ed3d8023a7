"""Best fuzzy match of every name among known names, exact, without meeting all pairs.

The score of a name and a seed is 2M / (la + lb), with M letters in matching blocks and the two
lengths. Blocks have at least one unmatched letter between them, so there are at most
1 + la + lb - 2M of them, and a block of s letters holds s - q + 1 common q-grams. A seed that
scores b therefore shares at least (2q - 1) M - (q - 1)(1 + la + lb) grams with the name, where
M >= b (la + lb) / 2, and its length lies between la b / (2 - b) and la (2 - b) / b.

1. Seeds that are a beginning or an end of a name, or else those of its rarest grams, are scored; the best sets its b.
2. Of the name's g grams at most g - c may be missing in a seed that shares c, so its g - c + 1
   rarest grams fetch every seed that can still reach b. Pairs or triples of letters are taken,
   whichever fetch less.
3. Names whose b is low or whose grams are common look at groups of similar seeds instead:
   the letters that a group's seeds have at most bound the score of all of them, and groups whose
   bound is below b are passed over, first with the b of step 1, then with that of the best group.
   Inside a group the letters that two texts share are counted for many names and seeds at once.

What the letters leave is bounded by the longest common subsequence before blocks are matched.

Seeds that fit one group are looked at without an index. Every step compares with bounds that hold for ties too, so the result equals that of all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lodegate.functions.binding import stage
from lodegate.scale import lookup_join, skew_join
from lodegate.session import materialize

NAMES_PER_TASK = 4096
SEEDS_PER_GROUP = 2048
MOST_GROUPS = 4096  # so the summaries of groups stay below 3 MB
STARTERS, STARTER_SEEDS = 3, 200
INDEX_SHARE = 1 / 256  # a name whose grams fetch more than this share of the seeds looks at groups instead
NAMES_AT_ONCE = 256
_CLASSES = 64
_FOUND = "name_key string, entity_id string, confidence double"


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How often each class of letters occurs in each text, and the lengths."""
    lengths = np.array([len(text) for text in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32) % _CLASSES
    cells = np.repeat(np.arange(len(texts)), lengths) * _CLASSES + codes
    return np.bincount(cells, minlength=len(texts) * _CLASSES).reshape(-1, _CLASSES).astype(np.int32), lengths


def _bounds(shared: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.where(total == 0, 1.0, 2.0 * shared / np.maximum(total, 1))


def _places(text: str) -> dict[str, int]:
    """Where each letter of a text stands, as bits."""
    places: dict[str, int] = {}
    for at, letter in enumerate(text):
        places[letter] = places.get(letter, 0) | 1 << at
    return places


def _common(places: dict[str, int], length: int, seed: str) -> int:
    """Letters in the longest common subsequence, which matching blocks never exceed."""
    whole = free = (1 << length) - 1
    for letter in seed:
        met = free & places.get(letter, 0)
        free = ((free + met) | (free - met)) & whole
    return length - free.bit_count()


class _Scores:
    """Exact scores; what a seed needs for them is kept while it is in use."""

    def __init__(self) -> None:
        self._seeds: dict[str, SequenceMatcher] = {}

    def __call__(self, name: str, seed: str) -> float:
        if len(self._seeds) > 2 * SEEDS_PER_GROUP:
            self._seeds.clear()
        matcher = self._seeds.get(seed)
        if matcher is None:
            matcher = self._seeds[seed] = SequenceMatcher(b=seed)
        matcher.set_seq1(name)
        return matcher.ratio()


def _score_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best seed per name among the pairs (name_key, least, seed_key, entity_id) of a batch."""
    for batch in batches:
        names, least, seeds, ids = (column.to_pylist() for column in batch.columns)
        (of_names, la), (of_seeds, lb) = _letters(names), _letters(seeds)
        bound = _bounds(np.minimum(of_names, of_seeds).sum(axis=1), la + lb)
        best: dict[str, tuple[float, str]] = {}
        score, places = _Scores(), {}
        for at in np.argsort(-bound, kind="stable"):
            held = best.get(names[at])
            reach = held[0] if held else least[at]
            if bound[at] < reach:
                continue
            if names[at] not in places:
                places[names[at]] = _places(names[at])
            if 2.0 * _common(places[names[at]], int(la[at]), seeds[at]) >= reach * (la[at] + lb[at]) - 1e-6:
                found = (score(names[at], seeds[at]), ids[at])
                best[names[at]] = max(held, found) if held else found
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(best), pa.string()), pa.array([b[1] for b in best.values()], pa.string()), pa.array([b[0] for b in best.values()], pa.float64())],
            names=["name_key", "entity_id", "confidence"],
        )


def _best(found: DataFrame) -> DataFrame:
    best = found.groupBy("name_key").agg(F.max(F.struct("confidence", "entity_id")).alias("best"))
    return best.select("name_key", "best.entity_id", "best.confidence")


# --- The gram index ----------------------------------------------------------------------------


def _grams(key: Column, q: int) -> Column:
    count = F.greatest(F.length(key) - (q - 1), F.lit(0))
    places = F.slice(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), F.lit(1), count)
    return F.transform(places, lambda at: F.substr(key, at, F.lit(q)))


def _needed(q: int) -> Column:
    """Grams that a seed scoring ``least`` shares with the name, at its shortest."""
    slope = (2 * q - 1) * F.col("least") / 2 - (q - 1)
    shortest = 2 * F.length("name_key") / (2 - F.col("least"))
    return F.when(slope > 0, F.ceil(shortest * slope - (q - 1) - 1e-6)).otherwise(F.lit(0))


def _with_grams(names: DataFrame, counts: DataFrame) -> DataFrame:
    """Each name with its q-grams (g2, g3: seeds that hold it, gram), rarest first."""
    key = F.col("name_key")
    single = names.select("name_key", F.explode(F.concat(_grams(key, 2), _grams(key, 3))).alias("gram"))
    counted = lookup_join(single, counts, ["gram"], "left", spread=key).withColumn("seeds", F.coalesce("seeds", F.lit(0).cast("long")))
    listed = counted.groupBy("name_key").agg(F.array_sort(F.collect_list(F.struct("seeds", "gram"))).alias("grams"))
    of = lambda q: F.filter("grams", lambda g: F.length(g["gram"]) == q).alias(f"g{q}")
    return listed.select("name_key", of(2), of(3))


def _fetch(chosen: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs of names and the seeds that hold one of their chosen grams and whose length can reach ``least``."""
    asked = chosen.select("name_key", "least", F.explode(F.array_distinct("chosen")).alias("g")).select("name_key", "least", "g.gram").distinct()
    met = skew_join(asked, index, ["gram"], spread=F.col("name_key"))
    la, lb, b = F.length("name_key"), F.length("seed_key"), F.col("least")
    return met.filter((lb * (2 - b) >= la * b - 1e-6) & (la * (2 - b) >= lb * b - 1e-6)).select("name_key", "least", "seed_key", "entity_id").distinct()


def _affixes(names: DataFrame, seeds: DataFrame) -> DataFrame:
    """Pairs of names and the longest seeds that they begin or end with, at least half of the name."""
    key = F.col("name_key")
    length = F.length(key)
    sizes = F.when(length > 1, F.sequence(F.ceil(length / 2).cast("int"), length)).otherwise(F.array(length))
    cuts = F.concat(F.transform(sizes, lambda n: F.substr(key, F.lit(1), n)), F.transform(sizes, lambda n: F.substr(key, length - n + 1, n)))
    asked = names.select("name_key", F.explode(F.array_distinct(cuts)).alias("seed_key"))
    met = skew_join(asked, seeds, ["seed_key"], spread=key)
    longest = met.groupBy("name_key").agg(F.max(F.struct(F.length("seed_key").alias("size"), "seed_key", "entity_id")).alias("seed"))
    return longest.select("name_key", F.lit(0.0).alias("least"), "seed.seed_key", "seed.entity_id")


# --- Groups of similar seeds -------------------------------------------------------------------


def _summary(group: pd.DataFrame) -> pd.DataFrame:
    letters, lengths = _letters(group["seed_key"].tolist())
    return pd.DataFrame({"group": [group["group"].iloc[0]], "most": [letters.max(axis=0).tolist()], "shortest": [int(lengths.min())], "longest": [int(lengths.max())]})


def _visits(groups: np.ndarray, most: np.ndarray, shortest: np.ndarray, longest: np.ndarray, first_only: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(name_key, least, group) of the groups that may hold a seed scoring ``least`` or more, or of the likeliest only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, least = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            letters, lengths = _letters(keys)
            rows, at = [], []
            for row in range(len(keys)):
                # No seed shares more letters than this with the name, nor more than its own length.
                shared = np.minimum(np.minimum(most, letters[row]).sum(axis=1), longest)
                bound = _bounds(shared, lengths[row] + np.maximum(shortest, shared))
                wanted = np.array([int(np.argmax(bound))]) if first_only else np.flatnonzero((bound >= least[row]) & (bound > 0))
                rows.append(np.full(len(wanted), row)), at.append(wanted)
            row, at = np.concatenate(rows), np.concatenate(at)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(least[row], pa.float64()), pa.array(groups[at], pa.int32())], names=["name_key", "least", "group"])

    return run


def _best_in_group(names: pd.DataFrame, seeds: pd.DataFrame) -> pd.DataFrame:
    """Best seed of one group for each of some names, looked at from the highest bound down to ``least``."""
    ids, keys = seeds["entity_id"].tolist(), seeds["seed_key"].tolist()
    own, leasts = names["name_key"].tolist(), names["least"].to_numpy()
    (of_seeds, lb), (of_names, la) = _letters(keys), _letters(own)
    small = np.uint8 if max(la.max(initial=0), lb.max(initial=0)) < 256 else np.int32
    of_seeds, of_names = np.ascontiguousarray(of_seeds.T.astype(small)), of_names.astype(small)
    score, found = _Scores(), []
    for start in range(0, len(own), NAMES_AT_ONCE):
        block = slice(start, start + NAMES_AT_ONCE)
        letters = of_names[block]
        shared = np.zeros((len(letters), len(keys)), dtype=small)
        for kind in np.flatnonzero(letters.any(axis=0) & of_seeds.any(axis=1)):
            shared += np.minimum(letters[:, kind, None], of_seeds[kind])
        bounds = _bounds(shared, la[block, None] + lb)
        wanted = (bounds >= leasts[block, None]) & (bounds > 0)
        for row in np.flatnonzero(wanted.any(axis=1)):
            name, bound = own[start + row], bounds[row]
            places, best = _places(name), (float(leasts[start + row]), "")
            open_seeds = np.flatnonzero(wanted[row])
            for at in open_seeds[np.argsort(-bound[open_seeds], kind="stable")]:
                if bound[at] < best[0]:
                    break
                if 2.0 * _common(places, len(name), keys[at]) >= best[0] * (len(name) + len(keys[at])) - 1e-6:
                    best = max(best, (score(name, keys[at]), ids[at]))
            if best[1]:
                found.append((name, best[1], best[0]))
    return pd.DataFrame(found, columns=["name_key", "entity_id", "confidence"])


def _by_groups(names: DataFrame, seeds: DataFrame, count: int) -> DataFrame:
    """Best matches of (name_key, least) among groups of seeds; nothing for names that no seed shares a letter with."""
    many = min(MOST_GROUPS, max(1, math.ceil(count / SEEDS_PER_GROUP)))
    dealt = seeds.repartitionByRange(many, F.length("seed_key"), "seed_key").withColumn("group", F.spark_partition_id())
    grouped = materialize(dealt, "seed-groups")
    told = grouped.groupBy("group").applyInPandas(_summary, "group int, most array<int>, shortest int, longest int").toPandas()
    summary = (told["group"].to_numpy(), np.array(told["most"].tolist(), dtype=np.int32), told["shortest"].to_numpy(), told["longest"].to_numpy())
    found: list[DataFrame] = []
    for first_only in (True, False):
        visits = materialize(names.mapInArrow(_visits(*summary, first_only), "name_key string, least double, group int"), "visits")
        # A group that many names look at is taken by as many tasks as it needs.
        parts = F.broadcast(visits.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / NAMES_PER_TASK).cast("int").alias("parts")))
        left = visits.join(parts, "group").withColumn("part", F.pmod(F.xxhash64("name_key"), F.col("parts")).cast("int")).drop("parts")
        right = grouped.join(parts, "group").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        scored = left.groupBy("group", "part").cogroup(right.groupBy("group", "part")).applyInPandas(_best_in_group, _FOUND)
        found.append(materialize(_best(scored), "group-matches"))
        if first_only and many == 1:
            break
        names = names.join(found[0].select("name_key", F.col("confidence").alias("reached")), "name_key", "left").select(
            "name_key", F.greatest("least", F.coalesce("reached", F.lit(0.0))).alias("least")
        )
    return reduce(DataFrame.unionByName, found)


# --- All steps -----------------------------------------------------------------------------------


def match_steps(names: DataFrame, seeds: DataFrame) -> dict[str, DataFrame]:
    """Tables of the three steps: started, candidates and matches of the index, names left to groups, their matches."""
    seeds = materialize(seeds.groupBy("seed_key").agg(F.max("entity_id").alias("entity_id")), "seeds")
    names = materialize(names.select("name_key").distinct(), "names")
    count, last = seeds.agg(F.count(F.lit(1)), F.max("entity_id")).first()
    nothing = names.select("name_key", F.lit(last).cast("string").alias("entity_id"), F.lit(0.0).alias("confidence"))
    key = F.col("seed_key")
    if count <= SEEDS_PER_GROUP:
        # One group holds all seeds: each name looks at them from the highest bound down.
        rest = names.withColumn("least", F.lit(0.0))
        none = names.select("name_key", F.lit(None).cast("string").alias("entity_id"), F.lit(0.0).alias("confidence")).filter("false")
        return {"started": none, "candidates": none, "indexed": none, "rest": rest, "grouped": _by_groups(rest, seeds, count) if count else none, "nothing": nothing}
    index = materialize(
        seeds.select("seed_key", "entity_id", F.explode(F.array_distinct(F.concat(_grams(key, 2), _grams(key, 3)))).alias("gram")), "gram-index"
    )
    counts = materialize(index.groupBy("gram").agg(F.count(F.lit(1)).alias("seeds")), "gram-counts")
    grams = materialize(_with_grams(names, counts), "name-grams")

    # A seed inside the name is a good start; only names without one ask their rarest grams.
    affixed = materialize(_best(_affixes(names, seeds).mapInArrow(_score_pairs, _FOUND)), "affixed")
    rare = F.filter(F.array_distinct(F.concat("g3", "g2")), lambda g: (g["seeds"] > 0) & (g["seeds"] <= STARTER_SEEDS))
    starters = grams.join(affixed, "name_key", "left_anti").select("name_key", F.lit(0.0).alias("least"), F.slice(F.array_sort(rare), 1, STARTERS).alias("chosen"))
    started = materialize(_best(_fetch(starters, index).mapInArrow(_score_pairs, _FOUND)).unionByName(affixed), "started")

    known = names.join(started, "name_key", "left").join(grams, "name_key", "left")
    known = known.select("name_key", F.coalesce("confidence", F.lit(0.0)).alias("least"), "g2", "g3")

    def prefix(q: int) -> Column:
        need = _needed(q)
        most = F.greatest(F.size(f"g{q}") - need + 1, F.lit(0)).cast("int")
        return F.when((need > 0) & F.col(f"g{q}").isNotNull(), F.slice(f"g{q}", F.lit(1), most))

    cost = lambda grams: F.aggregate(F.array_distinct(grams), F.lit(0).cast("long"), lambda total, g: total + g["seeds"])
    priced = stage(stage(known, {"p2": prefix(2), "p3": prefix(3)}), {"c2": cost("p2"), "c3": cost("p3")})
    cheaper = F.coalesce("c3", F.lit(count)) < F.coalesce("c2", F.lit(count))
    picked = stage(priced, {"chosen": F.when(cheaper, F.col("p3")).otherwise(F.col("p2")), "cost": F.least("c2", "c3")})
    routed = materialize(picked.select("name_key", "least", "chosen", (F.col("cost") <= max(STARTER_SEEDS, INDEX_SHARE * count)).alias("by_index")), "routed")
    candidates = materialize(_fetch(routed.filter("by_index"), index), "candidates")
    indexed = _best(candidates.mapInArrow(_score_pairs, _FOUND))
    rest = materialize(routed.filter(~F.coalesce("by_index", F.lit(False))).select("name_key", "least"), "rest")
    grouped = _by_groups(rest, seeds, count) if count and not rest.isEmpty() else started.filter("false")
    return {"started": started, "candidates": candidates, "indexed": indexed, "rest": rest, "grouped": grouped, "nothing": nothing}


def best_matches(names: DataFrame, seeds: DataFrame) -> DataFrame:
    """(name_key, entity_id, confidence) of the best scoring seed per distinct key.

    Scores compare the keys by longest matching blocks; ties go to the larger entity id.
    ``names`` holds name_key values, ``seeds`` seed_key and entity_id. A name without any
    letter in common with a seed has confidence 0 and the largest id; without seeds there
    are no rows.
    """
    steps = match_steps(names, seeds)
    found = reduce(DataFrame.unionByName, (steps[name] for name in ("started", "indexed", "grouped", "nothing")))
    return _best(found.filter(F.col("entity_id").isNotNull()))
