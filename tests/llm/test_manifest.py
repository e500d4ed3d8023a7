"""Multiproofs against proofs of single leaves over a tree held in memory."""

from __future__ import annotations

import hashlib
import zlib

from hypothesis import given, settings, strategies as st

from lodegate.llm.manifest import ARITY, height, missing, placed, proofs, tampered
from tests.llm.conftest import FOLDER
from tests.llm.harness import differences


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_h("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
    return levels


def _way(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    out = []
    for level in levels[:-1]:
        run = at // 8 * 8
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + 8])))
        at //= 8
    return out


def _leaf(doc_id, source, lang, n_chars, text) -> str:
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def _expected(rows: list[tuple]) -> list[tuple]:
    trees: dict = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, _leaf(*row), row))
    langs = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {lang: _tree([leaf for _, _, leaf, _ in sorted(trees[lang], key=lambda r: r[:3])]) for lang in langs}
    top = _tree([built[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for at, (_, _, leaf, row) in enumerate(sorted(trees[lang], key=lambda r: r[:3])):
            path = _way(built[lang], at) + _way(top, k)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]) if hit else row[4]
            folded = _leaf(*row[:4], text)
            for before, after in path:
                folded = _h(before + folded + after)
            proof = _h("".join(before + after for before, after in path))
            out.append((row[0], leaf, built[lang][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(map(str, out))


def _found(frame) -> list[str]:
    return sorted(str(tuple(row)) for row in frame.collect())


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, place int, tree string, leaf string, size string"


def _frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", "y", "z") for row in rows], SCHEMA).repartition(5)


def test_proofs_of_odd_tables(spark):
    rows = [(k, "s", "en", k, f"Text {k}") for k in range(0, 9000, 2)]  # more than one leaf partition
    rows += [(k, None, "de", None, "Ä b C") for k in range(65)] + [(5, "s", "fr", 1, "Only One")]
    rows += [(None, "s", None, 3, None), (None, "s", None, 3, None), (None, None, None, None, ""), (3, "", None, 0, "A" * 60_000), (3, "s", None, 0, "B"), (-9, "s", None, 0, "B")]
    rows += [(7, "s", "", 1, "Repeated")] * 70 + [(8, "s", "日本", 1, "x"), (9, "s", "eń", 1, "ẞ İ")]
    assert _found(proofs(_frame(spark, rows), tampered)) == _expected(rows)


def test_many_languages(spark):
    rows = [(k, "s", f"l{k % 4500}", k, f"Text {k}") for k in range(4600)]
    assert _found(proofs(_frame(spark, rows), tampered)) == _expected(rows)


def test_small_tables(spark):
    for rows in ([(1, "s", "en", 1, "One")], [(1, "s", "en", 1, "One"), (2, "s", "de", 1, "Two")], [(k, "s", "en", 1, "One") for k in range(8)]):
        assert _found(proofs(_frame(spark, rows), tampered)) == _expected(rows)
    assert proofs(_frame(spark, rows).filter("false"), tampered).count() == 0
    assert all(row["verified"] for row in proofs(_frame(spark, rows)).collect())


def test_given_documents(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r[n] for n in ("doc_id", "source", "lang", "n_chars", "text")) for r in frame.collect()]
    assert _found(proofs(frame, tampered)) == _expected(rows)


def test_places(spark):
    rows = [("=a" if k % 3 else "", k // 4 if k % 2 else None, k) for k in range(3000)]
    frame = spark.createDataFrame(rows, "tree string, doc_id long, leaf long").repartition(7)
    found = sorted((r["tree"], r["place"], r["size"], r["doc_id"], r["leaf"]) for r in placed(frame, "doc_id", "leaf").collect())
    expected = []
    for tree in ("", "=a"):
        own = sorted((r for r in rows if r[0] == tree), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        expected += [(tree, place, len(own), r[1], r[2]) for place, r in enumerate(own)]
    assert found == expected


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 700), st.data())
def test_missing_is_the_least_union(size, data):
    known = data.draw(st.sets(st.integers(0, size - 1), min_size=1, max_size=40))
    needed, derived, places, left = set(), set(), set(known), size
    derived |= {(0, p) for p in known}
    for level in range(height(size)):
        for place in places:
            needed |= {(level, p) for p in range(place // ARITY * ARITY, min(left, place // ARITY * ARITY + ARITY)) if p != place}
        places, left = {p // ARITY for p in places}, -(-left // ARITY)
        derived |= {(level + 1, p) for p in places}
    found = missing(known, size, height(size))
    assert len(found) == len(set(found)) and set(found) == needed - derived


def test_manifest_query_equals_its_sql(spark):
    assert differences(spark, FOLDER, "op13_octopus_manifest") == ""
