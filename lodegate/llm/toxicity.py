"""Toxicity of whole texts by a convolutional classifier, trained and run in numpy.

A word's vector is the sum of hashed embeddings of the word and of its beginnings, so forms of one
stem share what they mean. Filters of several widths slide over the words; each keeps its largest
value over the text, however long, and a logistic layer scores these. Training takes every labelled
row, whole, where it is read: in each of two rounds the tasks go on from one network, take their rows
in parts of about ``part_bytes`` of text or ``part_rows`` rows, and what they change is averaged, each
weight over the tasks that changed it; over all rounds each row is taken ``EPOCHS`` times at least. No
text is shuffled, so a network may differ with the layout of the table. Features are counted over all these rows too. A fifth of the rows is held back to set the
threshold, for each language that the text's own function words show, from counts of their scores in
narrow bins; a score is the logistic distance to it. The network grows with the vocabulary, not with the rows.

Inputs of a score are the text's words alone.

Defined cases: a null, empty or wordless text has the score of a text without any known word; rows
without a label, or of an id that has no text, don't train; an id with several labels trains as
toxic if one says so; with no label of one of the classes the score is the logistic of the class
share; equal rows have equal scores; an empty table gives an empty one.
"""

from __future__ import annotations

import copy
import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from lodegate.llm.arrays import CHUNK_BYTES, LETTERS, Texts, chunks, mix, powers, prefix_hash, range_hashes, string_parts
from lodegate.llm.context import materialize, prepare, texts
from lodegate.scale import lookup_join

PART_ROWS, PART_BYTES = 12_000, CHUNK_BYTES  # larger parts need larger tables of powers in every worker
ROUNDS, EPOCHS = 2, 2
BINS = 1024  # of a raw score's unit, to find a threshold
WIRE = 1 << 16  # weights that are averaged together
BEGINNINGS = (3, 4, 5, 6, 8)  # bytes
DIMENSIONS, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
LEAST_TEXTS = 4  # a feature of fewer training texts has no embedding
STEPS, BATCH, RATE, DECAY = 2_500, 32, 0.1, 1e-4  # at least so many steps, over all parts
DROPPED = 0.4  # share of a word's features left out at each step of training, so stems learn too
_PADS = max(WIDTHS)

# Common function words by language; words of two languages count for both.
_FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are with as his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son lui nous comme mais ont leur elle aux cette ses tout fait été aussi bien où sans",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está",
}


def _hash_words(words: list[str]) -> np.ndarray:
    raw = [word.encode() for word in words]
    ends = np.cumsum([len(w) for w in raw])
    return range_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), np.append(0, ends[:-1]), ends)


_LANGUAGES = {name: np.unique(_hash_words(words.split())) for name, words in _FUNCTION_WORDS.items()}


def languages(part: Texts) -> np.ndarray:
    """The index of the language with most function words in each text; one more index for none."""
    votes = []
    for hashes in _LANGUAGES.values():
        at = np.minimum(np.searchsorted(hashes, part.word_hashes), hashes.size - 1)
        sums = np.concatenate([[0], np.cumsum(hashes[at] == part.word_hashes)])
        votes.append(sums[part.word_offsets[1:]] - sums[part.word_offsets[:-1]])
    votes = np.stack(votes, axis=1)
    return np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), len(_LANGUAGES))


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of each word and of its beginnings, a column each; ranges are sorted."""
    cuts = [ends, *(np.minimum(ends, starts + size) for size in BEGINNINGS)]
    if data.size <= 4 * CHUNK_BYTES:
        sums = prefix_hash(data)
        _, down = powers(sums.size)
        hashes = [mix((sums[e] - sums[starts]) * down[starts]) for e in cuts]
    else:
        hashes = [range_hashes(data, starts, e) for e in cuts]
    return np.stack([mix(h + np.uint64(k + 1)) for k, h in enumerate(hashes)], axis=1)


def vocabulary(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Features of the distinct words, and which of them each word is."""
    starts, ends = part.words
    _, first, which = np.unique(part.word_hashes, return_index=True, return_inverse=True)
    order = np.argsort(first)
    found = np.empty((first.size, 1 + len(BEGINNINGS)), dtype=np.uint64)
    if first.size:
        found[order] = features(part.data, starts[first[order]], ends[first[order]])
    return found, which.reshape(-1)


@dataclass
class Network:
    keys: np.ndarray  # sorted hashes of the known features
    vectors: np.ndarray  # one row more than keys, of zeros
    filters: list[np.ndarray]  # by width: (width, dimensions, filters)
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray
    thresholds: np.ndarray  # by language

    def rows(self, found: np.ndarray) -> np.ndarray:
        if not self.keys.size:
            return np.zeros(found.shape, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, found), self.keys.size - 1)
        return np.where(self.keys[at] == found, at, self.keys.size)

    def padded(self, vectors: np.ndarray, which: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word vectors of texts with zero rows behind each, and where each text begins."""
        counts = np.diff(offsets)
        bounds = np.concatenate([[0], np.cumsum(counts + _PADS)])
        out = np.zeros((bounds[-1], vectors.shape[1]), dtype=np.float32)
        shift = np.repeat(np.arange(counts.size) * _PADS, counts)
        out[np.arange(which.size) + shift] = vectors[which]
        return out, bounds

    def convolve(self, words: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
        k = WIDTHS.index(width)
        out = words @ self.filters[k][0]
        for j in range(1, width):
            out[:-j] += words[j:] @ self.filters[k][j]
        out += self.biases[k]
        for j in range(1, width):
            out[bounds[1:] - j] = -np.inf
        return out

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.weights + self.bias[0]

    def raw_scores(self, part: Texts) -> np.ndarray:
        found, which = vocabulary(part)
        vectors = self.vectors[self.rows(found)].sum(axis=1) if found.size else np.zeros((0, DIMENSIONS), np.float32)
        words, bounds = self.padded(vectors, which, part.word_offsets)
        pooled = [np.maximum.reduceat(self.convolve(words, bounds, width), bounds[:-1], axis=0) for width in WIDTHS]
        return self.logits(np.concatenate(pooled, axis=1))

    def scores(self, part: Texts) -> np.ndarray:
        distance = self.raw_scores(part).astype(np.float64) - self.thresholds[languages(part)]
        return 1 / (1 + np.exp(-np.clip(distance, -40, 40)))


def _start(keys: np.ndarray, share: float, seed: int = 17) -> Network:
    """A network to train, for some sorted features; without any features it gives the logistic of the class share."""
    random = np.random.default_rng(seed)
    spread = 1.0 if keys.size else 0.0
    return Network(
        keys,
        np.vstack([random.normal(0, 0.1, (keys.size, DIMENSIONS)), np.zeros((1, DIMENSIONS))]).astype(np.float32),
        [spread * random.normal(0, 0.4, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        (spread * random.normal(0, 0.4, FILTERS * len(WIDTHS))).astype(np.float32),
        np.array([np.log(share / (1 - share))], np.float32),
        np.zeros(len(_LANGUAGES) + 1),
    )


def _weights(net: Network) -> list[np.ndarray]:
    return [net.vectors, *net.filters, *net.biases, net.weights, net.bias]


def _flat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([a.reshape(-1) for a in arrays])


def _refill(arrays: list[np.ndarray], values: np.ndarray) -> None:
    at = 0
    for array in arrays:
        array[...] = values[at : at + array.size].reshape(array.shape)
        at += array.size


def train(net: Network, memory: list[np.ndarray], part: Texts, labels: np.ndarray, turn: int, steps: int, seed: int) -> None:
    """One round of a part's training, on the rows whose turn it is; changes the network and its memory of gradients."""
    found, which = vocabulary(part)
    offsets, rows = part.word_offsets, net.rows(found)
    random = np.random.default_rng((seed, turn))
    state = {id(a): m for a, m in zip(_weights(net), memory)}

    def step(array: np.ndarray, gradient: np.ndarray, at=slice(None)) -> None:
        held = state[id(array)]
        held[at] += gradient**2
        array[at] -= RATE * gradient / np.sqrt(held[at])

    # A third of each batch is toxic; the thresholds undo what that does to the scores.
    sides = [(np.flatnonzero(labels == value), size) for value, size in ((0, BATCH - BATCH // 3), (1, BATCH // 3))]
    sides = [(side, size) for side, size in sides if side.size]
    count = max(math.ceil(steps / ROUNDS), *(math.ceil(EPOCHS * side.size / size / ROUNDS) for side, size in sides))
    # Each side is gone through in whole shuffles, one after another over the rounds.
    orders = []
    for side, size in sides:
        places = np.arange(turn * count * size, (turn + 1) * count * size)
        shuffles = {k: np.random.default_rng((seed, 1000 + k)).permutation(side) for k in np.unique(places // side.size).tolist()}
        orders.append(np.array([shuffles[p // side.size][p % side.size] for p in places.tolist()]).reshape(count, size))
    for k in range(count):
        _learn(net, step, rows, which, offsets, np.concatenate([order[k] for order in orders]), labels, random)


def _threshold(places: np.ndarray, negative: np.ndarray, positive: np.ndarray) -> float:
    """The middle of the cuts with the fewest errors, a missed and a false one of equal weight."""
    order = np.argsort(places)
    places, negative, positive = places[order], negative[order], positive[order]
    wrong = np.concatenate([[0], np.cumsum(positive)]) + negative.sum() - np.concatenate([[0], np.cumsum(negative)])
    best = np.flatnonzero(wrong == wrong.min())
    edges = np.concatenate([[places[0] - 1], places, [places[-1] + 1]]).astype(np.float64)
    middles = (edges[best] + edges[best + 1]) / 2
    return float(middles[np.argmax(edges[best + 1] - edges[best])])


def thresholds(counted: pd.DataFrame) -> np.ndarray:
    """By language, from rows of kind, place, negative and positive counts."""
    whole = counted.groupby("place", as_index=False)[["negative", "positive"]].sum()
    cut = lambda rows: _threshold(*(rows[name].to_numpy() for name in ("place", "negative", "positive")))
    overall = cut(whole) if len(whole) else 0.0
    out = np.full(len(_LANGUAGES) + 1, overall)
    for kind, rows in counted.groupby("kind"):
        if rows["positive"].sum() >= 20 and rows["negative"].sum() >= 20:
            out[kind] = cut(rows)
    return out


def _forward(net: Network, rows, which, offsets, batch, random=None):
    pieces = [which[offsets[d] : offsets[d + 1]] for d in batch]
    used, local = np.unique(np.concatenate(pieces), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum([p.size for p in pieces])])
    rows = rows[used]
    if random is not None:
        rows = np.where(random.random(rows.shape) < DROPPED, net.keys.size, rows)
    vectors = net.vectors[rows].sum(axis=1) if used.size else np.zeros((0, DIMENSIONS), np.float32)
    if random is not None:
        vectors = vectors / (1 - DROPPED)
    words, places = net.padded(vectors, local.reshape(-1), bounds)
    tops, at = [], []
    for width in WIDTHS:
        values = net.convolve(words, places, width)
        top = np.stack([values[a:b].argmax(axis=0) + a for a, b in zip(places[:-1], places[1:])])
        at.append(top)
        tops.append(values[top, np.arange(FILTERS)])
    pooled = np.concatenate(tops, axis=1)
    return net.logits(pooled), pooled, words, at, rows, local.reshape(-1), places, bounds


def _learn(net: Network, step, rows, which, offsets, batch, labels, random) -> None:
    logits, pooled, words, at, rows, local, places, bounds = _forward(net, rows, which, offsets, batch, random)
    error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[batch]).astype(np.float32) / batch.size
    hidden = np.maximum(pooled, 0)
    back = error[:, None] * net.weights[None, :] * (pooled > 0)
    into = np.zeros_like(words)
    for k, width in enumerate(WIDTHS):
        part = back[:, k * FILTERS : (k + 1) * FILTERS]
        gradient = np.zeros_like(net.filters[k])
        for j in range(width):
            seen = words[at[k] + j]  # texts, filters, dimensions
            gradient[j] = np.einsum("tf,tfd->df", part, seen)
            np.add.at(into, at[k] + j, part[:, :, None] * net.filters[k][j].T[None, :, :])
        step(net.filters[k], gradient + DECAY * net.filters[k])
        step(net.biases[k], part.sum(axis=0))
    step(net.weights, hidden.T @ error + DECAY * net.weights)
    step(net.bias, np.array([error.sum()], np.float32))
    # From padded places back to words, and to the features of each.
    hit = np.flatnonzero(np.abs(into).sum(axis=1))
    text = np.searchsorted(places, hit, "right") - 1
    inside = hit - places[text] < np.diff(bounds)[text]
    hit, text = hit[inside], text[inside]
    touched = rows[local[bounds[text] + hit - places[text]]]
    unique, inverse = np.unique(touched, return_inverse=True)
    total = np.zeros((unique.size, DIMENSIONS), np.float32)
    np.add.at(total, inverse.reshape(touched.shape), into[hit][:, None, :])
    known = unique < net.keys.size
    step(net.vectors, total[known], unique[known])


def _parts(batches: Iterator[pa.RecordBatch], part_rows: int, part_bytes: int) -> Iterator[tuple[Texts, np.ndarray]]:
    """The texts and labels of a task, some batches of (toxic, text) at a time."""
    held, rows, size = [], 0, 0
    for batch in itertools.chain(batches, [None]):
        if held and (batch is None or rows >= part_rows or size >= part_bytes):
            table = pa.Table.from_batches(held)
            data, offsets = string_parts(pa.concat_arrays([c.cast(pa.large_string()) for c in table.column("text").chunks]))
            yield Texts(data, offsets, LETTERS), table.column("toxic").to_numpy().astype(np.int64)
            held, rows, size = [], 0, 0
        if batch is not None and batch.num_rows:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes


def _masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and in how many texts their words occur; a beginning counts a text once for each of its words there."""
    for batch in batches:
        for _, _, part in chunks(batch.column(0), LETTERS):
            found, which = vocabulary(part)
            owner = np.repeat(np.arange(len(part)), np.diff(part.word_offsets))
            pairs = np.unique(owner * np.int64(found.shape[0]) + which)
            texts_of_word = np.bincount(pairs % max(1, found.shape[0]), minlength=found.shape[0])
            keys, inverse = np.unique(found, return_inverse=True)
            mass = np.bincount(inverse.reshape(-1), weights=np.repeat(texts_of_word, found.shape[1]), minlength=keys.size)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(mass.astype(np.int64))], ["feature", "mass"])


def _round(given: Broadcast, turn: int, steps: int, part_rows: int, part_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What one round on a task's rows changes in the given network, and its memory, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (net, memory), seed = copy.deepcopy(given.value), -1
        for seed, (part, labels) in enumerate(_parts(batches, part_rows, part_bytes)):
            train(net, memory, part, labels, turn, steps, seed)
        if seed < 0:
            return
        change = _flat(_weights(net))
        change -= _flat(_weights(given.value[0]))
        # The memory scales steps, for which half precision will do, and the last round leaves none.
        held = np.minimum(_flat(memory), 6e4).astype(np.float16) if turn + 1 < ROUNDS else np.zeros(0, np.float16)
        for block, cut in enumerate(range(0, change.size, WIRE)):
            values = [block], [change[cut : cut + WIRE].tobytes()], [held[cut : cut + WIRE].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, (pa.int32(), pa.binary(), pa.binary()))], ["block", "change", "memory"])

    return run


def _averaged(blocks: pa.Table) -> pa.Table:
    """The mean change of each weight over the tasks that changed it, the mean memory over all of them."""
    changes, memory = (
        np.stack([np.frombuffer(v, kind) for v in blocks.column(name).to_pylist()]).astype(np.float32)
        for name, kind in (("change", np.float32), ("memory", np.float16))
    )
    change = changes.sum(axis=0) / np.maximum((changes != 0).sum(axis=0), 1)
    return pa.table({"block": blocks.column("block")[:1], "change": [change.astype(np.float32).tobytes()], "memory": [memory.mean(axis=0).astype(np.float16).tobytes()]})


def fit(rows: DataFrame, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> Network:
    """The network of all rows of doc_id, toxic and text; one network at a time comes to the driver."""
    spark = rows.sparkSession
    told = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    count, toxic, size = told
    share = float(np.clip(toxic / count if count else 0.0, 1e-3, 1 - 1e-3))
    if toxic in (0, count):
        return _start(np.zeros(0, np.uint64), share)
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(5)) == 0
    features = rows.select("text").mapInArrow(_masses, "feature long, mass long").groupBy("feature").agg(F.sum("mass").alias("mass"))
    keys = features.filter(F.col("mass") >= LEAST_TEXTS).select("feature").toPandas()["feature"].to_numpy().astype(np.int64)
    net = _start(np.sort(keys.view(np.uint64)), share)
    memory = [np.full(a.shape, 1e-2, np.float32) for a in _weights(net)]
    parts = max(1, math.ceil(count / part_rows), math.ceil(size / part_bytes))
    dealt = rows.filter(~held).select("toxic", "text").coalesce(parts)
    steps = math.ceil(STEPS / parts)
    for turn in range(ROUNDS):
        given = spark.sparkContext.broadcast((net, memory))
        kind = "block int, change binary, memory binary"
        blocks = dealt.mapInArrow(_round(given, turn, steps, part_rows, part_bytes), kind).groupBy("block").applyInArrow(_averaged, kind).collect()
        if not blocks:  # every row is held back
            break
        blocks.sort(key=lambda row: row["block"])
        whole = lambda name, kind: np.concatenate([np.frombuffer(b[name], kind) for b in blocks])  # noqa: E731, B023
        _refill(_weights(net), _flat(_weights(net)) + whole("change", np.float32))
        if turn + 1 < ROUNDS:
            _refill(memory, whole("memory", np.float16))
        given.unpersist()
    shared = spark.sparkContext.broadcast(net)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in chunks(batch.column(1), LETTERS):
                place = np.floor(np.clip(shared.value.raw_scores(part), -40, 40) * BINS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], pa.array(languages(part)), pa.array(place)], ["toxic", "kind", "place"])

    scored = rows.filter(held).select("toxic", "text").mapInArrow(places, "toxic int, kind long, place long")
    counted = scored.groupBy("kind", "place").agg(F.count_if(F.col("toxic") == 0).alias("negative"), F.count_if(F.col("toxic") == 1).alias("positive"))
    net.thresholds = thresholds(counted.toPandas()) / BINS
    return net


def held_out(key: str = "doc_id"):
    """Whether 5 divides the CRC-32 of the decimal id; false for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    part_rows: int = PART_ROWS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """doc_id, held_out, score and predicted; labels of held-out ids are not looked at."""
    spark = prepare(docs.sparkSession)
    given = texts(docs, key, text)
    lowered = given.withColumn("text", F.lower("text"))
    known = labels.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("toxic"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    joined = lookup_join(lowered, known, ["doc_id"], "inner", spread=F.xxhash64("text"))
    net = fit(materialize(joined.select("doc_id", "toxic", "text"), "training"), part_rows, part_bytes)
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for low, high, part in chunks(batch.column(1), LETTERS):
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], pa.array(net.scores(part))], ["doc_id", "score"])

    scored = lowered.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
