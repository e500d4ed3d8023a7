"""Quality rules as weak supervision.

Each text gets counts; rules over the counts vote good (1), bad (-1) or abstain (0). The votes
of all texts fold into a histogram of vote patterns, whose size depends on the number of rules
only. Expectation-maximisation over that histogram estimates how each rule votes on good and on
bad texts, and the posterior probability of being good, with two base limits, decides.

Defined cases: a null or blank text has no words, all counts 0, and fails the base limits; equal
texts get equal results; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lodegate.llm.arrays import Texts, chunks, mix, range_hashes
from lodegate.llm.context import materialize, prepare, texts

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_bangs", "n_bars", "n_sentences", "n_short_words",
)
_SCHEMA = "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS)


def _members(of: bytes) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(of)] = True
    return flags


_SYMBOLS = _members(b"#*$%&|<>")
_UPPER = _members(bytes(range(65, 91)))
_LETTERS = _members(bytes(range(65, 91)) + bytes(range(97, 123)))
_SENTENCE = _members(b".!?")


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    sorted_keys = keys[order]
    same = sorted_keys[1:] == sorted_keys[:-1]
    flags = np.zeros(keys.size, dtype=bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return flags


def _line_counts(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those among them equal to an earlier line of their text."""
    breaks = np.flatnonzero(part.data == 10)
    starts = np.unique(np.concatenate([part.offsets[:-1], breaks + 1]))
    starts = starts[starts < part.data.size]
    if not starts.size:
        return np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
    ends = np.append(starts[1:], part.data.size)
    ends = ends - (part.data[ends - 1] == 10)
    word_starts = part.words[0]
    filled = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends = starts[filled], ends[filled]
    owner = np.searchsorted(part.offsets, starts, "right") - 1
    keys = mix(range_hashes(part.data, starts, ends) ^ mix(owner.astype(np.uint64)))
    lines = np.bincount(owner, minlength=len(part))
    _, first = np.unique(keys, return_index=True)
    return lines, lines - np.bincount(owner[first], minlength=len(part))


def _repeated_words(part: Texts, window: int) -> np.ndarray:
    """Words inside a window of ``window`` words that occurs twice or more in the text."""
    hashes, bounds = part.shingles(window)
    counts = np.diff(part.word_offsets)
    owner = np.repeat(np.arange(len(part)), np.diff(bounds))
    whole = counts[owner] >= window
    at = np.arange(hashes.size) - bounds[owner] + part.word_offsets[owner]
    hit = at[_repeats(mix(hashes ^ mix(owner.astype(np.uint64)))) & whole]
    covered = np.zeros(part.word_offsets[-1] + 1, dtype=bool)
    for k in range(window):
        covered[hit + k] = True
    sums = np.concatenate([[0], np.cumsum(covered[:-1])])
    return sums[part.word_offsets[1:]] - sums[part.word_offsets[:-1]]


def _count(part: Texts) -> dict[str, np.ndarray]:
    data = part.data
    word = part._word_bytes
    starts, ends = part.words
    lines, dup = _line_counts(part)
    sums = np.concatenate([[0], np.cumsum(ends - starts <= 3)])
    return {
        "n_words": np.diff(part.word_offsets),
        "word_chars": part.per_text(word & ((data & 0xC0) != 0x80)),
        "n_symbols": part.per_text(_SYMBOLS[data]),
        "n_dup_lines": dup,
        "n_repeat_words": _repeated_words(part, 3),
        "n_lines": lines,
        "n_upper": part.per_text(_UPPER[data]),
        "n_letters": part.per_text(_LETTERS[data]),
        "n_bangs": part.per_text(data == 33),
        "n_bars": part.per_text(data == 124),
        "n_sentences": part.per_text(_SENTENCE[data]),
        "n_short_words": sums[part.word_offsets[1:]] - sums[part.word_offsets[:-1]],
    }


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, part in chunks(batch.column(1)):
            counts = _count(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[low:high], *(pa.array(counts[name], pa.int64()) for name in COUNTS)],
                ["doc_id", *COUNTS],
            )


def count_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of every whole text, one narrow row each, by one pass without a shuffle."""
    return texts(docs, key, text).mapInArrow(_batches, _SCHEMA)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("symbols", "n_symbols > 0.3 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule("capitals", "n_letters > 0 AND n_upper > 0.6 * n_letters", "n_upper <= 0.2 * n_letters"),
    Rule("bangs", "n_bangs > 0.3 * n_words", "n_bangs <= 0.02 * n_words"),
    Rule("tables", "n_bars > 0.3 * n_words", "n_bars <= 0.02 * n_words"),
    Rule("duplicate_lines", "n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0"),
    Rule("repeated_words", "n_repeat_words > 0.4 * n_words", "n_repeat_words <= 0.1 * n_words"),
    Rule("sentences", "n_words >= 60 AND n_sentences = 0", "n_sentences > 0 AND n_sentences <= 0.5 * n_words"),
    Rule("word_length", "word_chars > 12 * n_words OR word_chars < 2 * n_words", "word_chars BETWEEN 3 * n_words AND 9 * n_words"),
    Rule("short_words", "n_words >= 60 AND n_short_words < 0.05 * n_words", "n_short_words >= 0.15 * n_words"),
)


def vote_columns(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    return [F.expr(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END").alias(f"vote_{r.name}") for r in rules]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass
class LabelModel:
    """prior: share of good texts; good, bad: by rule, the shares of votes -1, 0, 1 on such texts."""

    prior: float
    good: np.ndarray
    bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        at = votes + 1
        rule = np.arange(votes.shape[1])
        odds = np.log(self.prior) - np.log1p(-self.prior)
        odds = odds + (np.log(self.good[rule, at]) - np.log(self.bad[rule, at])).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


# A bad vote never speaks for a text, and a rule's bad votes hit at most this share of good texts.
_FALSE_ALARMS = 0.02


def fit(votes: np.ndarray, weights: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and how many texts have each.

    Starts from texts that any rule calls bad. Shares are smoothed by one text per outcome, and
    kept on their side: good votes are no likelier on bad texts, bad votes no likelier on good ones.
    """
    total = weights.sum()
    good_share = np.where((votes < 0).any(axis=1), 0.2, 0.95)
    model = LabelModel(0.5, np.full((votes.shape[1], 3), 1 / 3), np.full((votes.shape[1], 3), 1 / 3))
    for _ in range(rounds):
        prior = float(np.clip((weights @ good_share + 1) / (total + 2), 0.05, 0.98))
        shares = []
        for share in (good_share, 1 - good_share):
            mass = np.stack([(weights * share) @ (votes == v) for v in (-1, 0, 1)], axis=1) + 1
            shares.append(mass / mass.sum(axis=1, keepdims=True))
        good, bad = shares
        good[:, 0] = np.minimum(good[:, 0], _FALSE_ALARMS)
        bad[:, 0] = np.maximum(bad[:, 0], np.minimum(2 * good[:, 0], 0.5))
        bad[:, 2] = np.minimum(bad[:, 2], good[:, 2])
        good, bad = good / good.sum(axis=1, keepdims=True), bad / bad.sum(axis=1, keepdims=True)
        model = LabelModel(prior, good, bad)
        new = model.posterior(votes)
        if np.abs(new - good_share).max() < 1e-9:
            break
        good_share = new
    return model


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """Counts, votes, posterior and verdict of every text.

    Only the histogram of vote patterns, at most 3 to the number of rules, comes to the driver
    and goes back as a broadcast table.
    """
    prepare(docs.sparkSession)
    voted = materialize(count_texts(docs, key, text).select("*", *vote_columns(rules)), "votes")
    return _verdicts(voted, _posteriors(voted, rules), rules, threshold)


def _posteriors(voted: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The posterior of every pattern of votes that occurs."""
    names = [f"vote_{rule.name}" for rule in rules]
    patterns = voted.groupBy(*names).count().collect()
    spark = voted.sparkSession
    schema = ", ".join(f"{name} int" for name in names) + ", p_good double"
    if patterns:
        votes = np.array([[row[name] for name in names] for row in patterns], dtype=np.int64)
        posterior = fit(votes, np.array([row["count"] for row in patterns], dtype=float)).posterior(votes)
        rows = [(*map(int, vote), float(p)) for vote, p in zip(votes, posterior)]
    else:
        rows = []
    return spark.createDataFrame(rows, schema)


def _verdicts(voted: DataFrame, posteriors: DataFrame, rules: tuple[Rule, ...], threshold: float) -> DataFrame:
    scored = voted.join(F.broadcast(posteriors), [f"vote_{rule.name}" for rule in rules])
    failed = base_failed()
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("p_good") >= threshold))


def _counts_beside(at: int):
    """Whole rows with the counts of the text in column ``at`` next to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.StructArray.from_arrays(batch.columns, fields=list(batch.schema))
            for low, high, part in chunks(batch.column(at).cast(pa.string())):
                counts = _count(part)
                yield pa.RecordBatch.from_arrays([rows[low:high], *(pa.array(counts[name], pa.int64()) for name in COUNTS)], ["row", *COUNTS])

    return run


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``judge`` keeps; rows of one id stay or go together.

    A first pass over the texts fits the rules. A second one votes again on the rows as they are read
    and filters them, so no text is moved for its verdict. Only where an id has both a kept and a
    rejected row, such rejected rows meet the ids of the kept ones.
    """
    prepare(docs.sparkSession)
    voted = materialize(count_texts(docs, key, text).select("*", *vote_columns(rules)), "votes")
    posteriors = _posteriors(voted, rules)
    schema = T.StructType([T.StructField("row", docs.schema), *(T.StructField(name, T.LongType()) for name in COUNTS)])
    beside = docs.mapInArrow(_counts_beside(docs.columns.index(text)), schema)
    judged = _verdicts(beside.select("*", *vote_columns(rules)), posteriors, rules, threshold).select("row", "kept")
    verdicts = _verdicts(voted, posteriors, rules, threshold).groupBy("doc_id").agg(F.max("kept").alias("any"), F.min("kept").alias("all"))
    mixed = materialize(verdicts.filter(F.col("any") & ~F.col("all")).select(F.col("doc_id").alias("mixed_id")), "mixed-verdicts")
    good = judged.filter("kept").select("row.*")
    if mixed.isEmpty():
        return good
    bad = judged.filter("NOT kept")
    return good.unionByName(bad.join(mixed, F.col(f"row.`{key}`").cast("long").eqNullSafe(F.col("mixed_id")), "left_semi").select("row.*"))
