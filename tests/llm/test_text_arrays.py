"""Words, shingles, hashes, tokens and suffix order against plain Python."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from lodegate.llm.arrays import Texts, chunks, powers, range_hashes
from lodegate.llm.suffixes import cover, repeated_starts, stretches, suffix_order
from lodegate.llm.tokens import default_path, encoder

BLANKS = " \t\n\x0b\x0c\r"


def _words(text: str) -> list[str]:
    out, held = [], ""
    for c in text:
        if c in BLANKS:
            out += [held] if held else []
            held = ""
        else:
            held += c
    return out + ([held] if held else [])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t漢", max_size=25)), max_size=8), st.integers(1, 60))
def test_words_and_shingles(texts, limit):
    column = pa.array(texts, pa.string())
    seen: dict[tuple, int] = {}
    rows = 0
    for low, high, part in chunks(column, limit=limit):
        assert low == rows
        rows = high
        hashes, bounds = part.shingles(3)
        starts, ends = part.words
        for k, text in enumerate(texts[low:high]):
            words = _words(text or "")
            span = slice(part.word_offsets[k], part.word_offsets[k + 1])
            assert [bytes(part.data[s:e]).decode() for s, e in zip(starts[span], ends[span])] == words
            expected = [tuple(words[i : i + 3]) for i in range(max(min(len(words), 1), len(words) - 2))]
            found = hashes[bounds[k] : bounds[k + 1]].tolist()
            assert len(found) == len(expected)
            for shingle, value in zip(expected, found):
                assert seen.setdefault(shingle, value) == value
    assert rows == len(texts)
    assert len(set(seen.values())) == len(seen)


def test_range_hashes_do_not_depend_on_place():
    data = np.frombuffer(b"abcXabc" * 3, dtype=np.uint8)
    starts = np.array([0, 4, 7, 11])
    hashes = range_hashes(data, starts, starts + 3)
    assert len(set(hashes.tolist())) == 1


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=200) | st.text(alphabet="ab", max_size=200).map(str.encode))
def test_suffix_order(text):
    assert suffix_order(text, 400).tolist() == sorted(range(len(text)), key=lambda p: text[p:])


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=200) | st.text(alphabet="ab\0", max_size=200).map(str.encode), st.integers(1, 5), st.sampled_from([8, 9, 20, 200]))
def test_suffix_order_by_few_keys(text, keys, depth):
    order = suffix_order(text, depth, keys).tolist()
    assert sorted(order) == list(range(len(text)))
    assert [text[p : p + depth] for p in order] == sorted(text[p : p + depth] for p in range(len(text)))


def _peak(run) -> int:
    """Bytes allocated at once, by Python and numpy."""
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


@pytest.mark.parametrize("common", [0, 590])
def test_sorting_holds_no_copy_per_suffix(common):
    random_ = random.Random(5)
    strings = [("ab" * 300)[:common].encode() + "".join(random_.choice("abcdefgh ") for _ in range(600 - common)).encode() for _ in range(500)]
    peak = _peak(lambda: repeated_starts(strings, [len(s) - 400 + 1 for s in strings], 400))
    assert peak < 100 * 500 * 600


def test_cutting_works_in_small_blocks():
    data = np.random.default_rng(6).integers(97, 123, 1 << 21).astype(np.uint8)
    part = Texts(data, np.array([0, data.size]))
    stretches(Texts(data[:1000], np.array([0, 1000])), 400, 128)
    powers(1 << 21)
    assert _peak(lambda: stretches(part, 400, 128)) < 40 * data.size


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=9, max_size=40).map(str.encode), min_size=1, max_size=5))
def test_repeated_starts(strings):
    size = 9
    counts = [len(s) - size + 1 for s in strings]
    repeated, leads, _, _ = repeated_starts(strings, counts, size)
    windows = [s[k : k + size] for s, n in zip(strings, counts) for k in range(n)]
    assert repeated.tolist() == [windows.count(w) > 1 for w in windows]
    assert sorted(w for w, lead in zip(windows, leads) if lead) == sorted(set(windows))


def test_cover_joins_runs_that_touch():
    low, high = cover(np.array([20, 0, 5]), np.array([1, 2, 3]), 10)
    assert list(zip(low.tolist(), high.tolist())) == [(0, 17), (20, 30)]
    low, high = cover(np.array([10, 0]), np.array([1, 1]), 10)
    assert list(zip(low.tolist(), high.tolist())) == [(0, 20)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" 'strlemvd\n\t1é")), st.characters(codec="utf-8")), max_size=30), max_size=6))
def test_token_ids_are_the_library_s(texts):
    coder = encoder(default_path())
    expected = [e.ids for e in coder.library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in coder.encode(texts)] == expected


def test_token_ids_of_a_long_text_cut_at_spaces():
    text = "It's a long text that we'll cut. " * 40_000
    coder = encoder(default_path())
    assert coder.encode([text, "x"])[0].tolist() == coder.library.encode(text, add_special_tokens=False).ids
