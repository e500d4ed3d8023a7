"""Distributed operators against plain sequential models, with hot keys."""

import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F, types as T

from lodegate.operators.components import components, contractions
from lodegate.operators.dedupe import claim
from lodegate.operators import enrichment, ingest, matching, records
from lodegate.operators.entities import alias_conflicts, check_seeds, resolve_names
from lodegate.operators.extraction import merge_extractions
from lodegate.operators.limits import Breaker, circuit_breaker, token_bucket
from lodegate.operators.matching import best_matches, match_steps
from lodegate.operators.running import running
from lodegate.scale import first_per_key, hot_keys, skew_join
from lodegate.streaming.state import circuit_breaker_stream, token_bucket_stream


def sequential_claim(rows):
    urls, contents, won = set(), set(), set()
    for position, url, content in sorted(rows):
        if url not in urls and content not in contents:
            urls.add(url)
            contents.add(content)
            won.add(position)
    return won


def test_claim_keeps_rows_freed_by_a_rejected_row(spark):
    rows = spark.createDataFrame([(0, "u1", "h1"), (1, "u1", "h2"), (2, "u2", "h2")], "position int, u string, h string")
    assert {r["position"] for r in claim(rows, "u", "h", "position").filter("claimed").collect()} == {0, 2}


@pytest.mark.parametrize("seed", [1, 2])
def test_claim_equals_sequential_rule(spark, seed):
    chance = random.Random(seed)
    rows = [
        (i, f"u{0 if chance.random() < 0.35 else chance.randrange(40)}", f"h{0 if chance.random() < 0.35 else chance.randrange(60)}")
        for i in range(300)
    ]
    frame = spark.createDataFrame(rows, "position int, u string, h string")
    seen = spark.createDataFrame([("h3",), ("h4",)], "h string")
    got = {r["position"] for r in claim(frame, "u", "h", "position").filter("claimed").collect()}
    assert got == sequential_claim(rows)
    fresh = {r["position"] for r in claim(frame, "u", "h", "position", seen_contents=seen).filter("claimed").collect()}
    assert fresh == sequential_claim([r for r in rows if r[2] not in ("h3", "h4")])


def chain(start, length, name):
    """Pairs of which each shares a key with the next, in arrival order: every other one wins."""
    return [(start + i, f"{name}u{(i + 1) // 2}", f"{name}h{i // 2}") for i in range(length)]


def won(frame, **options):
    return {r["position"] for r in claim(frame, "u", "h", "position", **options).filter("claimed").collect()}


def claim_frame(spark, rows):
    return spark.createDataFrame(rows, "position long, u string, h string").repartition(5)


def test_claim_scans_a_long_chain(spark):
    rows = chain(0, 10_000, "a")
    assert won(claim_frame(spark, rows)) == set(range(0, 10_000, 2))


def test_claim_by_components(spark):
    # Chains fit a scan of their own, all of them together don't; a star is settled by a round.
    rows = [r for k in range(12) for r in chain(k * 1000, 300, f"c{k}-")]
    rows += [(20_000 + i, "hot", f"x{i}") for i in range(900)] + [(30_000 + i, f"y{i}", "c3-h7") for i in range(300)]
    assert won(claim_frame(spark, rows), at_once=350) == sequential_claim(rows)


def test_claim_of_a_component_larger_than_a_scan(spark):
    rows = chain(0, 700, "a") + [(5000 + i, f"z{i % 40}", f"au{i % 60}") for i in range(200)]
    assert won(claim_frame(spark, rows), at_once=150) == sequential_claim(rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_claim_at_any_scan_size(spark, seed):
    chance = random.Random(seed)
    rows = [(i, f"u{chance.randrange(120)}", f"h{chance.randrange(120)}") for i in range(260)]
    for at_once in (1, 40):
        assert won(claim_frame(spark, rows), at_once=at_once) == sequential_claim(rows)


def union_find(edges):
    above = {}

    def top(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in edges:
        above[top(a)] = top(b)
    return {x: top(x) for x in above}


def test_components_of_a_chain_take_few_rounds(spark):
    edges = [(i * 7919 % 1_000_003, (i + 1) * 7919 % 1_000_003) for i in range(10_000)]
    frame = spark.createDataFrame(edges, "a long, b long")
    rounds = contractions(frame, at_once=10)
    assert len(rounds) <= 16
    labels = {r["node"]: r["component"] for r in components(frame, at_once=10).collect()}
    assert len(labels) == 10_001 and len(set(labels.values())) == 1


def test_components_equal_union_find(spark):
    chance = random.Random(7)
    edges = [(chance.randrange(400), chance.randrange(400)) for _ in range(180)] + [(1000, 1000 + i) for i in range(50)] + [(2000, 2000)]
    frame = spark.createDataFrame(edges, "a long, b long")
    expected = union_find([e for e in edges if e[0] != e[1]])
    for at_once in (0, 30, 1000):
        labels = {r["node"]: r["component"] for r in components(frame, at_once).collect()}
        assert labels.keys() == expected.keys()
        assert len({(expected[n], labels[n]) for n in labels}) == len(set(expected.values())) == len(set(labels.values()))
    assert components(frame.filter("a = b"), 5).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, how):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 200).alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 150).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    plain = sorted(map(tuple, left.join(right, "k", how).collect()), key=str)
    salted = sorted(map(tuple, skew_join(left, right, ["k"], how, spread=F.col("v")).collect()), key=str)
    assert salted == plain


def test_hot_keys_are_few(spark):
    frame = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [(r["k"], r["_salts"]) for r in hot_keys(frame, ["k"]).collect()] == [(-1, 342)]


def test_first_per_key(spark):
    frame = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    for wide in (False, True):
        assert sorted(tuple(r) for r in first_per_key(frame, ["k"], "id", wide=wide).collect()) == [(i, i) for i in range(7)]


def test_running_values_cross_slices(spark):
    frame = spark.range(500).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"), (F.col("id") * 37 % 101).alias("v"))
    got = running(frame, ["k"], ["t"], maxima={"m": F.col("v")}, sums={"s": F.col("v")}, slices=9).collect()
    for key in (0, 1):
        best, total = -1, 0
        for row in sorted((r for r in got if r["k"] == key), key=lambda r: r["t"]):
            best, total = max(best, row["v"]), total + row["v"]
            assert (row["m"], row["s"]) == (best, total)


def bucket_model(requests, rate, burst):
    state, granted = {}, {}
    for host, at, position in sorted(requests, key=lambda r: (r[1], r[2])):
        tokens, updated, ready = state.get(host, (float(burst), at, at))
        now = max(at, ready)
        tokens = min(burst, tokens + (now - updated) * rate / 1e6)
        if tokens < 1 - 1e-9:
            now += (1 - tokens) * 1e6 / rate
            tokens = 1.0
        state[host] = (tokens - 1, now, now)
        granted[position] = now
    return granted


def requests(seed, count=400):
    chance = random.Random(seed)
    return [("hot" if chance.random() < 0.4 else f"h{chance.randrange(5)}", chance.randrange(60) * 1_000_000, i) for i in range(count)]


def test_token_bucket_equals_simulation(spark):
    rows = requests(5)
    frame = spark.createDataFrame(rows, "host string, at long, position int")
    got = token_bucket(frame, "host", "at", "position", rate_per_second=2.0, burst=3).collect()
    expected = bucket_model(rows, 2.0, 3)
    assert {r["position"]: pytest.approx(r["granted_micros"], abs=2) for r in got} == expected


def breaker_model(rows, threshold, cooldown):
    breakers, told = {}, {}
    for provider, at, position, failed in sorted(rows, key=lambda r: (r[1], r[2])):
        told[position] = breakers.setdefault(provider, Breaker(threshold, cooldown)).call(at, failed)
    return told


def calls(seed, count=600):
    chance = random.Random(seed)
    at, rows = 0, []
    for i in range(count):
        at += chance.choice([200_000, 1_000_000, 9_000_000])
        rows.append((chance.choice(["a", "a", "b"]), at, i, chance.random() < (0.7 if (i // 60) % 3 == 0 else 0.05)))
    return rows


def test_breaker_equals_replay(spark):
    rows = calls(3)
    frame = spark.createDataFrame(rows, "provider string, at long, position int, failed boolean")
    got = circuit_breaker(frame, "provider", "at", "position", "failed", threshold=3, cooldown_seconds=10).collect()
    expected = breaker_model(rows, 3, 10_000_000)
    assert {r["position"]: (r["allowed"], r["state"], r["failures"]) for r in got} == expected
    assert any(not told[0] for told in expected.values())


def test_breaker_opens_and_allows_one_trial():
    breaker = Breaker(2, 10)
    assert breaker.call(0, True) == (True, "CLOSED", 1)
    assert breaker.call(1, True) == (True, "OPEN", 2)
    assert breaker.call(10, False) == (False, "OPEN", 2)
    assert breaker.call(11, True) == (True, "OPEN", 2)
    assert breaker.call(22, False) == (True, "CLOSED", 0)


def in_batches(spark, frame, path, order, parts=3):
    for part in range(parts):
        lowest, highest = part * 10_000 // parts, (part + 1) * 10_000 // parts
        ranked = frame.filter((F.col(order) >= lowest) & (F.col(order) < highest))
        ranked.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_streams_carry_state_between_batches(spark, tmp_path):
    rows = sorted(requests(8, 300), key=lambda r: (r[1], r[2]))
    rows = [(host, at, n * 33) for n, (host, at, _) in enumerate(rows)]
    frame = spark.createDataFrame(rows, "host string, at long, position int")
    stream = in_batches(spark, frame, str(tmp_path / "requests"), "position")
    token_bucket_stream(stream, str(tmp_path / "b"), "host", "at", "position", rate_per_second=2.0, burst=3).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "b" / "grants")).collect()
    assert {r["position"]: pytest.approx(r["granted_micros"], abs=2) for r in got} == bucket_model(rows, 2.0, 3)

    log = [(provider, at, n * 16, failed) for provider, at, n, failed in calls(4)]
    frame = spark.createDataFrame(log, "provider string, at long, position int, failed boolean")
    stream = in_batches(spark, frame, str(tmp_path / "calls"), "position")
    circuit_breaker_stream(
        stream, str(tmp_path / "c"), "provider", "at", "position", "failed", threshold=3, cooldown_seconds=10
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "c" / "calls")).collect()
    assert {r["position"]: (r["allowed"], r["state"], r["failures"]) for r in got} == breaker_model(log, 3, 10_000_000)


def fold(left, right):
    """Sequential model of merging: the first non-empty value decides."""
    empty = lambda v: v is None or v == {} or v == []
    if empty(left) or empty(right):
        return right if empty(left) else left
    if isinstance(left, dict) and isinstance(right, dict):
        return {k: fold(left[k], right[k]) if k in left and k in right else left.get(k, right.get(k)) for k in {**left, **right}}
    if isinstance(left, list) and isinstance(right, list):
        extra = []
        for item in right:
            if item not in left and item not in extra:
                extra.append(item)
        return left + extra
    return left


def random_value(chance, depth=0):
    pick = chance.randrange(9 if depth < 2 else 6)
    if pick < 2:
        return chance.choice([None, {}, []])
    if pick < 4:
        return chance.choice(["", 0, False, 1, 1.0, True, "x", 2.5])
    if pick < 6:
        return [chance.choice([1, 1.0, "a", None, {"k": 1}]) for _ in range(chance.randrange(1, 4))]
    return {chance.choice("abc"): random_value(chance, depth + 1) for _ in range(chance.randrange(1, 4))}


def test_merge_equals_sequential_fold(spark):
    chance, rows, expected = random.Random(11), [], {}
    for key in range(120):
        parts = [{name: random_value(chance) for name in chance.sample("abcd", 3)} for _ in range(chance.randrange(1, 6))]
        merged = {}
        for n, part in enumerate(parts):
            rows.append((key, n, json.dumps(part)))
            merged = fold(merged, part)
        expected[key] = merged
    frame = spark.createDataFrame(rows, "k int, n int, payload string")
    got = {r["k"]: json.loads(r["merged"]) for r in merge_extractions(frame, "k", "n", "payload").collect()}
    assert got == expected


def test_merge_of_odd_keys_and_payloads(spark):
    rows = [
        (None, 1, '{"a": [1], "b c": {"x": null}}'), (None, 2, '{"a": [2, 1], "b c": {"x": {"y\\"": "\\u00e9"}}}'),
        (1, 1, None), (2, 1, "{}"), (3, 1, "[1, 2]"), (4, 1, "5"), (5, 1, '{"a": {"b": 1}}'), (5, 0, '{"a": 7}'),
        (6, 1, '{"a": {"b": 1}, "a\\"": 1, "": {"": [[], {}]}}'),
    ]
    frame = spark.createDataFrame(rows, "parent int, depth int, text string")
    got = {r["parent"]: r["merged"] for r in merge_extractions(frame, "parent", "depth", "text").collect()}
    assert {k: json.loads(v) for k, v in got.items()} == {
        None: {"a": [1, 2], "b c": {"x": {'y"': "é"}}}, 2: {}, 3: {}, 4: {}, 5: {"a": 7}, 6: {"a": {"b": 1}, 'a"': 1, "": {"": [[], {}]}},
    }
    assert got[None] == json.dumps(json.loads(got[None]), sort_keys=True)
    assert merge_extractions(frame.filter("false"), "parent", "depth", "text").count() == 0


def test_merge_of_one_key_with_very_many_items(spark):
    """A million items and fields of one key, in their order, from many ranges."""
    n = 1_000_000
    rows = spark.range(n // 4, numPartitions=8).selectExpr(
        "1 AS k", "id AS n", "concat('{\"l\": [', id * 2, ', ', id * 2 + 1, ', 0], \"f', id, '\": {\"v\": ', id, '}, \"s\": 1}') AS payload"
    )
    (row,) = merge_extractions(rows, "k", "n", "payload").collect()
    merged = json.loads(row["merged"])
    # The first part holds 0 twice and keeps both.
    assert merged["l"] == [0, 1, 0, *range(2, n // 2)] and merged["s"] == 1
    assert len(merged) == n // 4 + 2 and all(merged[f"f{k}"] == {"v": k} for k in range(0, n // 4, 97))


def best_of_all_pairs(names, seeds):
    return {name: max((SequenceMatcher(None, name, key).ratio(), entity) for entity, key in seeds) for name in names}


def found_best(spark, names, seeds):
    frames = spark.createDataFrame([(n,) for n in names], "name_key string"), spark.createDataFrame(seeds, "entity_id string, seed_key string")
    return {r["name_key"]: (r["confidence"], r["entity_id"]) for r in best_matches(*frames).collect()}


def test_best_match_equals_all_pairs(spark, monkeypatch):
    chance = random.Random(2)
    # More than one group of seeds, small starts, so that all three steps have work.
    monkeypatch.setattr(matching, "SEEDS_PER_GROUP", 40)
    monkeypatch.setattr(matching, "STARTER_SEEDS", 12)

    def word(letters, low, high):
        return "".join(chance.choice(letters) for _ in range(chance.randrange(low, high)))

    def edited(text):
        at = chance.randrange(len(text) + 1)
        return text[:at] + chance.choice(["", "x", "ab", "0"]) + text[at + chance.randrange(3) :]

    keys = [word("abcdeinorst", 3, 12) for _ in range(120)] + [word("ab", 1, 9) for _ in range(20)]
    keys += [f"supplier{n:05d}" for n in range(90)] + ["aaaaaaaa", "abababababab", "", "é漢字ab", "w" * 260 + "q", word("abc", 250, 300)]
    seeds = [(f"id{n:03d}", key) for n, key in enumerate(keys + keys[:30])]
    names = {word("abcdeinorst", 3, 12) for _ in range(60)} | {edited(edited(chance.choice(keys))) for _ in range(150)}
    names |= {"", "a", "ZZ", "aaaaa", "supplier00012labs", "supplier", "w" * 250, "bababa"}
    assert found_best(spark, sorted(names), seeds) == best_of_all_pairs(names, seeds)


def test_few_pairs_are_looked_at(spark):
    """Of 2000 names that differ from one of 3000 seeds by an edit or two, the index fetches few pairs."""
    chance = random.Random(5)
    word = lambda: "".join(chance.choice("abcdefghiklmnoprstuvw") for _ in range(chance.randrange(8, 18)))
    keys = sorted({word() for _ in range(3000)})
    names = sorted({k[:3] + chance.choice("xyz") + k[4:] for k in chance.sample(keys, 2000)})
    frames = spark.createDataFrame([(n,) for n in names], "name_key string"), spark.createDataFrame([(k, k) for k in keys], "entity_id string, seed_key string")
    steps = match_steps(*frames)
    assert steps["candidates"].count() < 0.005 * len(names) * len(keys)
    assert steps["rest"].count() < 0.01 * len(names)


def test_a_seed_inside_the_name_starts_it(spark, monkeypatch):
    """Names of which no gram is rare start with the seed that they begin or end with, not with every seed."""
    monkeypatch.setattr(matching, "SEEDS_PER_GROUP", 40)
    monkeypatch.setattr(matching, "STARTER_SEEDS", 1)
    seeds = [(f"id{n:03d}", f"supplier{n:09d}") for n in range(300)]
    names = [f"supplier{n:09d}labs" for n in range(0, 300, 6)] + [f"xsupplier{n:09d}" for n in range(0, 300, 6)]
    frames = spark.createDataFrame([(n,) for n in names], "name_key string"), spark.createDataFrame(seeds, "entity_id string, seed_key string")
    steps = match_steps(*frames)
    assert steps["candidates"].count() <= 0.01 * len(names) * len(seeds)
    best = {n: (f"id{n.strip('xlabs')[-3:]}", 34 / (17 + len(n))) for n in names}
    assert {r["name_key"]: (r["entity_id"], r["confidence"]) for r in steps["started"].collect()} == best
    assert {r["name_key"]: (r["entity_id"], r["confidence"]) for r in best_matches(*frames).collect()} == best


def test_one_row_for_a_name_that_several_seeds_claim(spark):
    seeds = seed_frame(spark, ("s:1", "Same", []), ("s:2", "Same Inc", []), ("s:3", "Other", ["Same Ltd"]))
    frame = spark.createDataFrame([("same",), ("Other",)], "raw_name string")
    got = sorted((r["raw_name"], r["canonical_entity_id"]) for r in resolve_names(frame, seeds).collect())
    assert got == [("Other", "s:3"), ("same", "s:3")]


def test_no_seeds_no_matches(spark):
    assert found_best(spark, ["abc"], [("x", "abc")]) == {"abc": (1.0, "x")}
    frame = spark.createDataFrame([("abc",)], "name_key string")
    assert best_matches(frame, spark.createDataFrame([], "entity_id string, seed_key string")).count() == 0
    assert best_matches(frame.filter("false"), spark.createDataFrame([("x", "abc")], "entity_id string, seed_key string")).count() == 0


def seed_frame(spark, *rows):
    return spark.createDataFrame(rows, "entity_id string, canonical_name string, aliases array<string>")


def test_resolution_levels(spark):
    seeds = seed_frame(spark, ("startup:openai", "OpenAI", ["Open AI"]), ("startup:anthropic", "Anthropic", None))
    names = ["OpenAI, Inc.", "Anthropic Labs", "Completely Unrelated Robotics", "  "]
    frame = spark.createDataFrame([(n,) for n in names], "raw_name string")
    got = {r["raw_name"]: r for r in resolve_names(frame, check_seeds(seeds)).collect()}
    assert (got["OpenAI, Inc."]["status"], got["OpenAI, Inc."]["method"]) == ("AUTO_MATCH", "exact")
    assert got["Anthropic Labs"]["status"] == "REVIEW" and got["Anthropic Labs"]["confidence"] == 18 / 22
    assert got["Completely Unrelated Robotics"]["canonical_name"] is None
    assert (got["  "]["status"], got["  "]["confidence"]) == ("UNRESOLVED", 0.0)


def test_conflicting_aliases_are_refused(spark):
    seeds = seed_frame(spark, ("startup:one", "One", ["Shared"]), ("startup:two", "Two", ["Shared Inc"]))
    assert alias_conflicts(seeds).count() == 1
    with pytest.raises(ValueError):
        check_seeds(seeds)


def test_summaries_count_documents_without_candidates(spark):
    documents = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "source_id string")
    made = spark.createDataFrame(
        [(1, "a", "r1", ["bad"]), (2, "a", "r1", []), (3, "a", "r1", []), (4, "a", "r2", [])],
        "n int, source_id string, record_id string, problems array<string>",
    )
    stored = spark.createDataFrame([("r2",)], "record_id string")
    counted = ingest.record_summary(made, documents, stored, "n")
    got = sorted((r["source_id"] or "", r["discovered"], r["parsed"], r["inserted"], r["duplicates"], r["rejected"]) for r in counted.collect())
    assert got == [("", 1, 0, 0, 0, 0), ("", 4, 4, 1, 2, 1), ("a", 2, 4, 1, 2, 1), ("b", 1, 0, 0, 0, 0)]
    empty = ingest.record_summary(made.limit(0), documents.limit(0), None, "n").collect()
    assert [tuple(r)[1:] for r in empty] in ([], [(0, 0, 0, 0, 0)])


def test_one_article_for_an_address_landed_more_than_once(spark):
    now = F.lit("2024-01-30 12:00:00+00:00").cast("timestamp")
    news = spark.createDataFrame(
        [(0, "u", "t", "b", None, "rss", 0.85), (1, "v", "t", "b", None, "rss", 0.85), (2, "w", "t", "b", None, "rss", 0.85)],
        "position int, original_url string, title string, body string, author string, date_source string, date_confidence double",
    ).withColumn("published_at", now)
    page = lambda title: f"<html><head><title>{title}</title></head><body><p>text</p></body></html>"
    pages = spark.createDataFrame([("u", page("late"), 2), ("u", page("first"), 1), ("u", page("first"), 1), ("v", page("v"), 3)], "original_url string, html string, retrieved_at int")
    made = enrichment.enrich_news(news, pages, "position", now)
    assert sorted((r["position"], r["title"]) for r in made.collect()) == [(0, "first"), (1, "v"), (2, "t")]
    made = enrichment.enrich_news(news, pages.drop("retrieved_at"), "position", now)
    assert [r["position"] for r in made.orderBy("position").collect()] == [0, 1, 2]


@pytest.mark.parametrize("record_type", ["NEWS", "JOB", "RESEARCH_PAPER", "STARTUP", "PRODUCT"])
def test_problems_of_a_record_equal_those_of_its_text(spark, record_type):
    chance = random.Random(record_type)
    texts = [None, "", " ", "x", "x" * 600, "http://a.b/c", "HTTP://a.b:9x/", "https://[::1]/", "a" * 64, "AI", "rss", "PAID", "2024-01-05", "2024-13-05"]
    columns = "source_id original_url canonical_url content_hash raw_document_id title author body category date_source company role_family description " \
        "paper_url github_url abstract full_name entity_name headquarters website canonical_entity_id raw_name product_name startup_name pricing_model".split()
    rows = []
    for at in range(150):
        usable = {"source_id": "s", "original_url": "http://a.b/c", "canonical_url": "https://a.b/c", "content_hash": "a" * 64, "raw_document_id": "d"}
        row = [usable[c] if c in usable and chance.random() < 0.8 else chance.choice(texts) for c in columns]
        rows.append((*row, chance.choice([None, -1, 0, 1990, 2300]), chance.choice([None, -1.0, 0.5, 30.0, float("nan"), float("inf")]), chance.choice([None, True, False]), chance.choice([None, ["a"], ["a", None], []]), at))
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns) + ", n long, x double, flag boolean, authors array<string>, at int").repartition(4)
    time = F.when(F.col("at") % 7 > 0, F.timestamp_seconds(F.col("at").cast("long") * 10_000_000))
    frame = frame.withColumns(
        {"stars": F.col("n"), "founded_year": F.col("n"), "employee_count": F.col("n"), "date_confidence": F.col("x"), "resolution_confidence": F.col("x"),
         "is_remote": F.col("flag"), "raw_document_ids": F.array("raw_document_id"), "retrieved_at": time, "published_at": time,
         "decision": F.struct(time.alias("published_at"), F.col("x").alias("age_hours"), F.col("date_source").alias("source"), F.col("x").alias("confidence"))}
    )
    made = {"NEWS": records.news_record, "JOB": records.job_record, "RESEARCH_PAPER": records.paper_record, "STARTUP": records.startup_record, "PRODUCT": records.product_record}
    built = frame.select("at", made[record_type]().alias("record")).localCheckpoint()
    told = records.record_violations(F.col("record"), built.schema["record"].dataType, record_type)
    read = records.violations(F.to_json("record", {"ignoreNullFields": "false"}), record_type)
    both = built.select("at", told.alias("told"), read.alias("read")).collect()
    assert [r["told"] for r in both] == [r["read"] for r in both] and any(r["told"] for r in both)
    other = T.StructType([T.StructField("recordId", T.LongType())])
    assert records.record_violations(F.col("record"), other, record_type) is None
