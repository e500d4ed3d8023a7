"""Quality, near-duplicates, repeats, packing, leaks, toxicity and the pipeline on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lodegate.llm import leaks, toxicity
from lodegate.llm.arrays import LETTERS, Texts, chunks
from lodegate.llm.bagminhash import near_classes, signatures
from lodegate.llm.components import components
from lodegate.llm.leaks import align, find_leaks
from lodegate.llm.packing import pack, sequences, shortest_pack_first
from lodegate.llm.quality import fit, judge
from lodegate.llm.suffixes import without_repeats
from lodegate.llm.tokens import default_path
from lodegate.llm.toxicity import held_out, score
from lodegate.session import Scratch, materialize
from tests.llm.conftest import FOLDER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _counts(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    dup = sum(line in lines[:k] for k, line in enumerate(lines))
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def test_quality_counts(odd, documents):
    both = odd.select("doc_id", "text").filter("text IS NULL OR length(text) < 25000").unionByName(documents.select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in judge(both).collect())
    assert found == sorted((str(r["doc_id"]), *_counts(r["text"])) for r in both.collect())


def test_quality_of_long_and_odd_texts(odd, nothing):
    rows = judge(odd).collect()
    assert len(rows) == odd.count()
    assert not any(r["kept"] for r in rows if r["base_failed"])
    assert judge(nothing).count() == 0


def test_label_model_finds_the_better_rule():
    random_ = np.random.default_rng(3)
    good = random_.random(20_000) < 0.8
    sharp = np.where(good, 1, np.where(random_.random(good.size) < 0.9, -1, 0))
    dull = np.where(random_.random(good.size) < 0.5, 1, 0)
    third = np.where(~good & (random_.random(good.size) < 0.7), -1, 1)
    patterns, inverse, counts = np.unique(np.stack([sharp, dull, third], axis=1), axis=0, return_inverse=True, return_counts=True)
    posterior = fit(patterns, counts.astype(float)).posterior(patterns)[inverse.reshape(-1)]
    assert ((posterior >= 0.5) == good).mean() > 0.97


def _bag(text: str | None) -> Counter:
    words = WORD.findall(text or "")
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def _brute_classes(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    parent = {key: key for key, _ in rows}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [(key, _bag(text)) for key, text in rows]
    for k, (a, left) in enumerate(bags):
        for b, right in bags[:k]:
            common = sum((left & right).values())
            if common and common >= 0.8 * (left.total() + right.total() - common) - 1e-9:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {key: find(key) for key in parent}


def _near_rows() -> list[tuple[int, str | None]]:
    random_ = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    rows: list[tuple[int, str | None]] = []
    base = random_.choices(words, k=120)
    for k in range(45):  # edited copies of one text, some close to each other only by others
        copy = list(base)
        for _ in range(random_.choice([0, 1, 1, 2, 3, 4])):
            copy[random_.randrange(len(copy))] = random_.choice(words)
        rows.append((k, " ".join(copy)))
    for k in range(100, 130):
        rows.append((k, " ".join(random_.choices(words, k=random_.choice([1, 3, 5, 8, 60])))))
    rows += [(200, "same same same"), (201, "same  same\nsame"), (202, "a b c d e f " * 30), (203, "a b c d e f " * 31), (204, "a b c d e f " * 60)]
    return rows + [(300, None), (301, ""), (302, " "), (303, "")]


def test_near_classes_equal_brute_force(spark, documents):
    rows = _near_rows() + [(r["doc_id"] + 1000, r["text"]) for r in documents.collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in near_classes(frame, leads=4).collect()}
    assert found == _brute_classes(rows)


def test_near_classes_of_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["class_id"]) for r in near_classes(odd).collect()]
    assert sorted(rows, key=str) == sorted([(k, k) for k in range(1, 9)] + [(None, None)] * 2, key=str)
    assert near_classes(nothing).count() == 0


def test_signatures_estimate_weighted_jaccard():
    size = 2000
    owner = np.array([0, 0, 0, 1, 1, 1])
    key = np.array([5, 6, 7, 5, 6, 8], dtype=np.uint64)
    weight = np.array([7, 1, 3, 2, 5, 3])
    signature = signatures(owner, key, weight, 2, size)
    assert abs((signature[0] == signature[1]).mean() - (2 + 1) / (7 + 5 + 3 + 3)) < 0.03


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    random_ = random.Random(5)
    if shape == "chain":
        edges = [(k, k + 1) for k in range(1500)]
    elif shape == "star":
        edges = [(700, k) for k in range(600)] + [(900, 900)]
    else:
        edges = [(random_.randrange(400), random_.randrange(400)) for _ in range(250)]
    parent = {x: x for e in edges for x in e}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    for remainder in (10_000, 0):
        found = components(spark.createDataFrame(edges, "a long, b long"), remainder).collect()
        assert {r["node"]: r["component"] for r in found} == {x: find(x) for x in parent}
        assert len(found) == len(parent)


def _brute_repeats(rows: list[tuple], size: int) -> list[tuple]:
    raw = [(key, (text or "").encode()) for key, text in rows]
    often = Counter(b[k : k + size] for _, b in raw for k in range(len(b) - size + 1))
    out = []
    for key, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if often[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((str(key), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _repeats(frame, **options) -> list[tuple]:
    rows = without_repeats(frame, **options).collect()
    return sorted((str(r["doc_id"]), r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]), len(r["spans"]), r["kept_sha256"]) for r in rows)


@pytest.mark.parametrize("group", [2048, 3])
def test_repeats_equal_brute_force(spark, group):
    random_ = random.Random(2)
    passage = "".join(random_.choice("abcd é") for _ in range(90))
    rows = [(k, "".join(random_.choice("xyz") for _ in range(random_.randrange(60))) + passage[: random_.randrange(90)] + "q" * random_.randrange(70)) for k in range(80)]
    rows += [(90, "ab" * 200), (91, "a" * 300), (92, None), (93, "é" * 100), (94, rows[0][1]), (94, rows[0][1]), (None, "zz" + passage)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert _repeats(frame, size=40, gram=8, group=group) == _brute_repeats(rows, 40)


def test_repeats_of_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect() if not r["text"] or len(r["text"]) < 25_000]
    assert _repeats(odd.filter("text IS NULL OR length(text) < 25000")) == _brute_repeats(rows, 400)
    assert len(_repeats(odd)) == odd.count()
    assert without_repeats(nothing).count() == 0


def test_packing(odd, nothing):
    library = Tokenizer.from_file(default_path())
    rows = [r.asDict() for r in pack(odd, with_ids=True).collect()]
    whole = Counter((str(r["doc_id"]), tuple(library.encode(r["text"] or "", add_special_tokens=False).ids) + (0,)) for r in odd.collect())
    by_place: dict[int, list] = {}
    for row in rows:
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], dtype="<u4").tobytes())
        assert row["length"] == len(row["ids"])
        by_place.setdefault(row["sequence_id"], []).append(row)
    for parts in by_place.values():
        at = 0
        for part in sorted(parts, key=lambda r: r["offset"]):
            assert part["offset"] == at
            at += part["length"]
        assert at <= 1024
    assert sum(r["length"] for r in rows) == sum(len(ids) * n for (_, ids), n in whole.items())
    for (key, ids), n in whole.items():
        for start in range(0, len(ids), 1024):
            same = [r for r in rows if str(r["doc_id"]) == key and r["start"] == start and tuple(r["ids"]) == ids[start : start + 1024] and r["doc_tokens"] == len(ids)]
            assert len(same) == n
    assert sorted(by_place) == list(range(len(by_place)))
    packed = pack(odd, with_ids=True)
    assert sum(len(r["ids"]) for r in sequences(packed).collect()) == sum(r["length"] for r in rows)
    assert pack(nothing).count() == 0


def test_shortest_pack_first_uses_each_piece_once():
    random_ = random.Random(4)
    histogram = {length: random_.randrange(1, 500) for length in random_.sample(range(1, 257), 120)}
    packs = shortest_pack_first(histogram, 256)
    used: Counter = Counter()
    for count, lengths in packs:
        assert sum(lengths) <= 256
        for length in lengths:
            used[length] += count
    assert used == histogram
    total = sum(k * n for k, n in histogram.items())
    assert sum(count for count, _ in packs) * 256 <= 1.05 * total


def _align(a: list[int], b: list[int]) -> int:
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (1 if x == y else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
    return max(map(max, table))


def test_alignment_equals_the_plain_recurrence():
    random_ = np.random.default_rng(9)
    items, passages = random_.integers(1, 5, (40, 9)).astype(np.uint64), random_.integers(1, 5, (40, 14)).astype(np.uint64)
    m, n = random_.integers(1, 10, 40), random_.integers(1, 15, 40)
    found = align(items, m, passages, n)
    assert found.tolist() == [_align(a[:x].tolist(), b[:y].tolist()) for a, b, x, y in zip(items, passages, m, n)]


def test_leaks(spark, documents, odd, nothing):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    random_ = random.Random(8)
    tests = {r["item_id"]: r["text"].split() for r in items.collect()}
    vocabulary = sorted({w for words in tests.values() for w in words})
    rows = []
    for key, words in tests.items():
        edited = [random_.choice(vocabulary) if random_.random() < 0.12 else w for w in words]
        rows.append((10_000 + key, " ".join(random_.choices(vocabulary, k=150) + edited + random_.choices(vocabulary, k=150))))
    planted = documents.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    for block in (400_000, 300):
        found = {(r["doc_id"], r["item_id"]): r["score"] for r in find_leaks(planted, items, block_words=block).collect()}
        exact = {(r["doc_id"], k) for r in documents.collect() for k, words in tests.items() if " ".join(words) in r["text"]}
        assert exact and all(found[pair] > 0.9 for pair in exact)
        assert all((10_000 + key, key) in found for key in tests)
        assert len(found) <= len(exact) + len(tests) + 3
    assert find_leaks(odd, items).count() == 0
    assert find_leaks(nothing, items).count() == 0
    assert find_leaks(documents, items.filter("false")).count() == 0
    short = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (4, "one two three")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in find_leaks(odd, short).collect()] == [(4, 4)]


@pytest.mark.parametrize("copy", [False, True])
def test_leaks_with_every_fourth_word_changed(spark, copy):
    sizes = {16: 7, 31: 14, 59: 28}
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in sizes]
    rows = [(100 * n, text) for n, text in items if copy]
    for n, text in items:
        for shift in range(4):
            edited = ["changed" if k % 4 == shift else word for k, word in enumerate(text.split())]
            rows.append((100 * n + shift + 1, " ".join(["before"] * 90 + edited + ["behind"] * 90)))
    found = find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(key, key // 100) for key, _ in rows}
    assert all(r["score"] * r["item_id"] >= sizes[r["item_id"]] - 1e-9 for r in found)


def test_leaks_of_one_text_with_very_many_seeds(spark, monkeypatch):
    texts_ = pa.array(["a b c d e " * 40 + "x " * 30 + "a b c d e", "a b c", "q"])
    words = [f"a b c d e {k}" for k in range(6)]
    hashed = pa.Table.from_batches(list(leaks._hash_items(iter([pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(words)], ["k", "t"])])))).to_pylist()
    grams, bounds = leaks._flat(hashed, "grams")
    sizes, owner = np.full(6, 6), np.repeat(np.arange(6), np.diff(bounds))
    known, order = leaks._Set(grams), np.argsort(grams, kind="stable")
    first = np.searchsorted(grams[order], known.hashes)
    many = np.diff(np.append(first, grams.size))
    part = next(chunks(texts_, leaks._INSIDE))[2]

    def passages():
        steps = leaks._passages(part, known, order, first, many, owner, np.arange(grams.size) - bounds[owner], np.where(owner == 2, 1, 50), sizes)
        return sorted(row for step in steps for row in zip(*(x.tolist() for x in step)))

    whole = passages()
    monkeypatch.setattr(leaks, "_PROPOSALS", 7)
    assert passages() == whole and len(whole) == 18


def test_leaks_of_short_items(spark):
    names = {n: [f"n{n}w{k}" for k in range(n)] for n in range(6, 18)}
    rows, expected = [], set()
    for n, words in names.items():
        for place in range(1, n - 1):
            changed = [place] if n < 10 else [place, (place + 4) % n]
            edited = ["changed" if k in changed else word for k, word in enumerate(words)]
            if max(_align([hash(w) for w in words], [hash(w) for w in edited]), 0) >= min(6, n - 2):
                expected.add((len(rows), n))
            rows.append((len(rows), " ".join(["before"] * 20 + edited + ["behind"] * 20)))
    assert {n for _, n in expected} == set(names) and len(expected) > 0.9 * len(rows)
    # A phrase that very many texts hold proves nothing; two words only as a whole text.
    common = "this is one of the best"
    rows += [(1000 + k, f"that is one of the best {k}") for k in range(30)] + [(2000, "Just two."), (2001, "just two words"), (2002, "just")]
    rows += [(3000, "前文。今天天气真的很好吗?后文"), (3001, "今天天气不好")]
    items = [(n, " ".join(words)) for n, words in names.items()] + [(100, common), (101, "just two"), (102, "今天天气真的很好吗")]
    found = find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected | {(2000, 101), (3000, 102)}


def test_all_alignments_whatever_the_corpus(spark):
    """Without evidence a pair's row is the same in a small and a large corpus, and equals an alignment over whole texts."""
    random_ = random.Random(4)
    words = {k: [f"i{k}w{n}" for n in range(random_.randint(6, 18))] for k in range(40)}
    rows = []
    for k, item in words.items():
        edited = [f"e{random_.randrange(1 << 30)}" if random_.random() < 0.25 else w for w in item if random_.random() > 0.1]
        rows.append((k, " ".join(["before"] * 9 + edited + ["behind"] * 9)))
    schema = "doc_id long, text string"
    items = spark.createDataFrame([(k, " ".join(w)) for k, w in words.items()], "item_id long, text string")
    more = spark.createDataFrame([(1000 + k, " ".join(words[0][:4]) + f" filler {k}") for k in range(60)], schema)
    small = spark.createDataFrame(rows, schema)
    expected = {}
    for k, text in rows:
        given = text.split()
        gain = _align([hash(w) for w in words[k]], [hash(w) for w in given])
        grams = {tuple(given[n : n + 3]) for n in range(len(given))}
        if gain / len(words[k]) >= 0.4 and any(tuple(words[k][n : n + 3]) in grams for n in range(len(words[k]) - 2)):
            expected[k] = gain
    columns = ("doc_id", "item_id", "gain", "item_words")
    found = {tuple(r[c] for c in columns) for r in find_leaks(small, items, evidence=None).collect()}
    large = find_leaks(small.unionByName(more), items, evidence=None).filter("doc_id < 1000").collect()
    assert found == {(k, k, gain, len(words[k])) for k, gain in expected.items()} == {tuple(r[c] for c in columns) for r in large}
    strict = {tuple(r[c] for c in columns) for r in find_leaks(small, items).collect()}
    assert strict < found
    assert find_leaks(small, items, evidence=None).count() == find_leaks(small, items, evidence=None, block_words=60).count()


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    scored = score(documents, labels).join(labels, "doc_id").collect()
    unseen = [r for r in scored if r["held_out"]]
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5)
    right = sum(r["predicted"] == r["toxic"] for r in unseen) / len(unseen)
    assert right > 0.93


def test_toxicity_learns_from_every_labelled_row(spark):
    """A word that only toxic rows have, spread over many parts; rows beyond the first of each part count as well."""
    rows = [(k, f"the {'venom' if k % 5 == 0 else 'water'}{k % 40} of word{k % 7} and day", int(k % 5 == 0)) for k in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = score(frame.drop("toxic"), frame.drop("text"), part_rows=500).join(frame, "doc_id").collect()
    assert len(got) == 3000 and all(r["predicted"] == r["toxic"] for r in got)
    net = toxicity.fit(frame, part_rows=500)
    whole = Texts(np.frombuffer(b"".join(r[1].encode() for r in rows), np.uint8), np.cumsum([0] + [len(r[1]) for r in rows]), LETTERS)
    assert (net.rows(toxicity.vocabulary(whole)[0]) < net.keys.size).all()


def test_toxicity_of_odd_rows(spark, odd, nothing):
    none = spark.createDataFrame([(1, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    rows = score(odd, none).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 and not r["predicted"] for r in rows)
    assert score(nothing, none).count() == 0
    assert odd.select(held_out().alias("h")).filter("h IS NULL").count() == 0
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    before = docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == names
            assert docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()


def test_pipeline_on_odd_rows(spark, odd, nothing):
    clashing = odd.withColumns({"dropped": F.lit(1), "kept_id": F.lit(2), "row": F.lit(3), "vote_symbols": F.lit(4), "n_words": F.lit("x")})
    for frame in (odd, nothing, clashing, odd.drop("n_chars")):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            rows = stage(spark, frame, FOLDER)
            assert k == 4 or rows.columns == frame.columns
            rows.collect()


def test_stages_against_their_operators(spark, documents):
    """Each filtering stage keeps exactly the rows that its operator's verdict keeps."""
    twice = documents.limit(150).unionByName(documents.limit(150).withColumn("text", F.lit("too short"))).unionByName(documents)
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda frame: sorted(r["doc_id"] for r in frame.collect())
    good = {r["doc_id"] for r in judge(twice).filter("kept").collect()}
    assert ids(stages["quality"](spark, twice, FOLDER)) == [key for key in ids(twice) if key in good]
    firsts = {r["class_id"] for r in near_classes(documents).collect()}
    assert ids(stages["near_duplicates"](spark, documents, FOLDER)) == sorted(firsts)


def test_scratch_of_a_stage_goes(spark, documents, tmp_path):
    with Scratch() as scratch:
        table = materialize(documents.select("doc_id"), "kept")
        assert table.count() == documents.count()
    path = Path(scratch._paths[0].removeprefix("file:"))
    assert path.exists()
    scratch.remove(spark)
    assert not path.exists() and scratch._paths == []
