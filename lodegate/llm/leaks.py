"""Benchmark items inside training texts: n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased. An item's seeds are all its three-word grams
that some document of the corpus holds, counted over all of it; the other grams can't be met. A
text position that holds a seed proposes the item around it; proposals of one item that overlap
are one passage. The local alignment of the item with the passage gains 1 for an equal
word and loses 1 for a changed, missing or added one; the score is its gain over the item's words.
``aligned_passages`` returns every passage whose score reaches the threshold, with its gain and in how many
texts its rarest gram occurs, whatever the corpus is. Two common words prove nothing, so ``find_leaks``
asks for evidence beside the score (``evident``), which a caller may change or leave out.
Items are taken in blocks of bounded size against all texts, so either side may grow.

Each character of a script without spaces is a word.

Defined cases: null and empty texts and items match nothing; an item under three words only matches
a text that has the same words and no other;
equal texts each have their rows; an item of an id given twice is two items with that id, and the
best score counts; an empty table on either side gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lodegate.llm.arrays import Texts, chunks, list_array
from lodegate.llm.context import materialize, prepare, texts

GRAM = 3
THRESHOLD = 0.4
_UNSPACED = "[" + "".join(rf"\p{{{name}}}" for name in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")) + "]"
BLOCK_WORDS = 400_000
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _spaced(given: pa.Array) -> pa.Array:
    """The texts with each character of a script without spaces between two of them."""
    some = pc.match_substring_regex(given, _UNSPACED)
    if not pc.any(some).as_py():
        return given
    return pc.if_else(some, pc.replace_substring_regex(given, f"({_UNSPACED})", r" \1 "), given)


def _hash_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, part in chunks(_spaced(batch.column(1)), _INSIDE):
            grams, bounds = part.shingles(GRAM)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[low:high],
                    list_array(part.word_hashes.view(np.int64), part.word_offsets, pa.int64()),
                    list_array(grams.view(np.int64), bounds, pa.int64()),
                ],
                ["item_id", "words", "grams"],
            )


class _Set:
    """Sorted hashes with a bit table in front, for many lookups of which few hit."""

    BITS = 22

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.table = np.zeros(1 << self.BITS, dtype=bool)
        self.table[(self.hashes >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that are members, and which member each is."""
        maybe = np.flatnonzero(self.table[(hashes >> np.uint64(64 - self.BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), self.hashes.size - 1)
        same = self.hashes[at] == hashes[maybe]
        return maybe[same], at[same]


def _count(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """In how many texts each gram occurs, and with a null gram all texts, summed over the task: a row a gram at most."""
        known = _Set(shared.value)
        counts = np.zeros(known.hashes.size, dtype=np.int64)
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, part in chunks(_spaced(batch.column(1)), _INSIDE):
                grams, bounds = part.shingles(GRAM)
                hit, member = known.find(grams)
                owner = np.searchsorted(bounds, hit, "right") - 1
                both = np.unique(owner * np.int64(known.hashes.size) + member)
                counts += np.bincount(both % known.hashes.size, minlength=known.hashes.size)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([*known.hashes[seen].view(np.int64).tolist(), None], pa.int64()), pa.array([*counts[seen].tolist(), rows], pa.int64())], ["gram", "n"])

    return run


def align(items: np.ndarray, item_sizes: np.ndarray, passages: np.ndarray, passage_sizes: np.ndarray) -> np.ndarray:
    """Best local alignment gain of each row's item and passage; rows are padded on the right."""
    count, width = passages.shape
    column = np.arange(width + 1, dtype=np.int32)
    valid = np.arange(width)[None, :] < passage_sizes[:, None]
    before = np.zeros((count, width + 1), dtype=np.int32)
    best = np.zeros(count, dtype=np.int32)
    for k in range(items.shape[1]):
        on = (k < item_sizes)[:, None]
        step = np.where((items[:, k : k + 1] == passages) & valid & on, 1, -1)
        now = np.zeros_like(before)
        now[:, 1:] = np.maximum(before[:, :-1] + step, before[:, 1:] - 1)
        np.maximum(now, 0, out=now)
        # A gap along the passage costs 1 a word: the best of all earlier columns, less the way.
        now = np.maximum.accumulate(now + column, axis=1) - column
        best = np.maximum(best, np.where(on[:, 0], now.max(axis=1), 0))
        before = now
    return best


_CELLS = 1 << 21


_PASSAGE = ("item_id", "score", "gain", "item_words", "rarest", "start", "stop")


def _search(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, bounds, seeds, seed_items, seed_places, seed_texts = shared.value
        sizes = np.diff(bounds)
        known = _Set(seeds)
        order = np.argsort(seeds, kind="stable")
        first = np.searchsorted(seeds[order], known.hashes)
        many = np.diff(np.append(first, seeds.size))
        for batch in batches:
            for low, high, part in chunks(_spaced(batch.column(1)), _INSIDE):
                for owner, item, start, stop, rarest in _passages(part, known, order, first, many, seed_items, seed_places, seed_texts, sizes):
                    gain = _score(part, owner, item, start, stop, words, bounds)
                    score = gain / np.maximum(sizes[item], 1)
                    near = score >= threshold - 1e-12
                    keys = batch.column(0)[low:high].take(pa.array(owner[near]))
                    numbers = (ids[item], score, gain, sizes[item], rarest, start, stop)
                    yield pa.RecordBatch.from_arrays([keys, *[pa.array(x[near]) for x in numbers]], ["doc_id", *_PASSAGE])

    return run


def _merge(owner, item, low, high, texts_):
    """Passages of one text and item that overlap as one; passages that were merged may be merged again."""
    sort = np.lexsort((low, item, owner))
    owner, item, low, high, texts_ = owner[sort], item[sort], low[sort], high[sort], texts_[sort]
    group = np.ones(owner.size, dtype=bool)
    group[1:] = (owner[1:] != owner[:-1]) | (item[1:] != item[:-1])
    # The furthest end so far within a group.
    number = np.cumsum(group)
    top = np.maximum.accumulate(high + number * np.int64(1 << 40)) - number * np.int64(1 << 40)
    new = group.copy()
    new[1:] |= low[1:] >= top[:-1]
    at = np.flatnonzero(new)
    return owner[at], item[at], low[at], np.maximum.reduceat(top, at), np.minimum.reduceat(texts_, at)


_PROPOSALS = 1 << 19


def _passages(part, known, order, first, many, seed_items, seed_places, seed_texts, sizes):
    """(text, item, first word, word behind, texts that hold its rarest seed) of each passage that holds seeds of the item.

    A bounded number of proposals at once; what the last text has so far is merged with its next.
    """
    grams, bounds = part.shingles(GRAM)
    hits, members = known.find(grams)
    total = np.cumsum(many[members])
    counts = np.diff(part.word_offsets)
    held = None
    at = 0
    while at < hits.size:
        done = total[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(total, done + _PROPOSALS, "right")))
        hit, member = hits[at:until], members[at:until]
        copies = many[member]
        which = np.repeat(first[member], copies) + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        seed = order[which]
        hit = np.repeat(hit, copies)
        owner = np.searchsorted(bounds, hit, "right") - 1
        item = seed_items[seed]
        begin = hit - bounds[owner] - seed_places[seed]
        slack = sizes[item] // 4 + 4
        low = np.maximum(begin - slack, 0)
        high = np.minimum(begin + sizes[item] + slack, counts[owner])
        found = _merge(owner, item, low, high, seed_texts[seed])
        if held is not None:
            found = _merge(*(np.concatenate(x) for x in zip(held, found)))
        at = until
        last = found[0] == found[0][-1] if at < hits.size else np.zeros(found[0].size, dtype=bool)
        held = tuple(x[last] for x in found)
        yield tuple(x[~last] for x in found)


def _score(part, owner, item, start, stop, words, bounds) -> np.ndarray:
    """Alignment gains, rows of like sizes together and few enough cells at once."""
    gain = np.zeros(owner.size, dtype=np.int64)
    item_size, passage_size = bounds[item + 1] - bounds[item], stop - start
    rows = np.lexsort((passage_size, item_size))
    text_words = part.word_hashes
    at = 0
    while at < rows.size:
        wide, until = 1, at
        while until < rows.size:
            wider = max(wide, int(passage_size[rows[until]]))
            if until > at and wider * (until - at + 1) > _CELLS // 8:
                break
            wide, until = wider, until + 1
        now = rows[at:until]
        # Zero stands for no word on either side; positions beyond a row's size never match.
        n, m = passage_size[now], item_size[now]
        place = np.arange(wide)[None, :]
        left = (part.word_offsets[owner[now]] + start[now])[:, None] + place
        passages = text_words[np.minimum(left, text_words.size - 1)]
        place = np.arange(int(m.max()))[None, :]
        items = words[np.minimum(bounds[item[now]][:, None] + place, words.size - 1)]
        gain[now] = align(items, m, passages, n)
        at = until
    return gain


def _flat(rows: list, name: str) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum([len(row[name]) for row in rows])]).astype(np.int64)
    values = np.concatenate([np.array(row[name], dtype=np.int64) for row in rows]) if rows else np.zeros(0, np.int64)
    return values.view(np.uint64), bounds


def _seeds(bounds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which grams are seeds, and the item of each: all that a text of the corpus holds."""
    chosen = np.flatnonzero(counts)
    return chosen, np.searchsorted(bounds, chosen, "right") - 1


def aligned_passages(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Each passage (words ``start`` to ``stop`` of a text) that holds a seed of an item and aligns with the threshold at least.

    Beside the score: its gain, the item's words, how many texts hold the rarest gram that the passage
    shares with the item, and how many texts there are.
    """
    spark = prepare(docs.sparkSession)
    given = texts(docs, key, text).withColumn("text", F.lower("text"))
    tests = texts(items, item, item_text, {"key": "item_id"}).withColumn("text", F.lower("text"))
    hashed = materialize(tests.mapInArrow(_hash_items, "item_id long, words array<long>, grams array<long>").filter("size(grams) > 0"), "items")
    total = hashed.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    hashed = hashed.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
    schema = "doc_id long, item_id long, score double, gain long, item_words long, rarest long, start long, stop long"
    found = spark.createDataFrame([], f"{schema}, n_texts long")
    for block in range(blocks):
        rows = hashed.filter(F.col("block") == block).select("item_id", "words", "grams").collect()
        words, word_bounds = _flat(rows, "words")
        grams, gram_bounds = _flat(rows, "grams")
        if not rows:
            continue
        ids = np.array([np.iinfo(np.int64).min if row["item_id"] is None else row["item_id"] for row in rows], dtype=np.int64)
        shared = spark.sparkContext.broadcast(np.unique(grams))
        counted = given.mapInArrow(_count(shared), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
        seen = {row["gram"]: row["n"] for row in counted}
        counts = np.array([seen.get(gram, 0) for gram in grams.view(np.int64).tolist()], dtype=np.int64)
        chosen, owners = _seeds(gram_bounds, counts)
        places = chosen - gram_bounds[owners]
        shared = spark.sparkContext.broadcast((ids, words, word_bounds, grams[chosen], owners, places, counts[chosen]))
        part = given.mapInArrow(_search(shared, threshold), schema)
        found = found.unionByName(part.withColumn("n_texts", F.lit(seen.get(None, 0)).cast("long")))
    known = F.when(F.col("item_id") != np.iinfo(np.int64).min, F.col("item_id"))
    return found.withColumn("item_id", known)


def evident(
    least_gain: int = 8, rare_gain: int = 6, rare_edited: int = 6, rare_texts: int = 10, rare_share: float = 0.01
) -> Column:
    """Whether a passage is more than a chance meeting of common words.

    It needs a gain of ``least_gain``, or all words of a shorter item. Where it holds a gram that at most
    ``rare_texts`` texts have, or such a share of them, ``rare_gain`` is enough, or all words but 2 of an item
    that has ``rare_edited`` words at least.
    """
    words, gain = F.col("item_words"), F.col("gain")
    least = F.least(F.lit(least_gain), words)
    rare = F.col("rarest") <= F.greatest(F.lit(float(rare_texts)), rare_share * F.col("n_texts"))
    return gain >= F.when(rare & (words >= rare_edited), F.least(F.lit(rare_gain), words - 2)).otherwise(least)


def find_leaks(docs: DataFrame, items: DataFrame, *, evidence: Callable[[], Column] | None = evident, **options) -> DataFrame:
    """(doc_id, item_id, score, gain, item_words, rarest) of the best aligned passage of each text and item.

    Without ``evidence`` every pair that reaches the threshold is there; ``options`` are those of ``aligned_passages``.
    """
    found = aligned_passages(docs, items, **options)
    if evidence is not None:
        found = found.filter(evidence())
    best = F.max(F.struct("score", "gain", "item_words", (-F.col("rarest")).alias("rarest"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.score", "best.gain", "best.item_words", (-F.col("best.rarest")).alias("rarest")
    )
