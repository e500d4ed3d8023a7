"""Contour integration against dense eigenvectors, exact sums against whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lodegate.llm.whitening import above, exact_products, intervals, leading, whiten
from tests.llm.conftest import FOLDER


def _spectrum(values, seed=1):
    base, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (base * np.array(values)) @ base.T


SPECTRA = {
    "spread": np.linspace(1, 100, 40), "decaying": 0.5 ** np.arange(40), "repeated": [5.0] * 20 + [1.0] * 20, "close": 1 + 1e-9 * np.arange(40),
    "pairs": np.repeat(np.arange(20.0), 2), "rank one": [1.0] + [0.0] * 39, "negative": np.linspace(-3, 3, 41), "single": [2.0], "zero": [0.0] * 5,
}


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("scale", [1.0, 1e-12, 1e12])
def test_leading_pairs(name, scale):
    matrix = _spectrum(SPECTRA[name]) * scale
    matrix = (matrix + matrix.T) / 2
    true = np.linalg.eigvalsh(matrix)[::-1]
    size = max(abs(true)) or 1.0
    values, vectors = leading(matrix, 16)
    k = min(16, len(matrix))
    assert np.allclose(values, true[:k], atol=1e-12 * size, rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * size


def test_vectors_of_separate_eigenvalues_equal_the_dense_ones():
    matrix = _spectrum(SPECTRA["spread"])
    _, vectors = leading(matrix, 16)
    dense = np.linalg.eigh(matrix)[1][:, ::-1][:, :16]
    assert np.allclose(np.abs((vectors * dense).sum(axis=0)), 1, atol=1e-13)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10_000))
def test_inertia_counts(size, seed):
    random = np.random.default_rng(seed)
    matrix = random.integers(-3, 4, (size, size)).astype(float)
    matrix = matrix + matrix.T
    true = np.linalg.eigvalsh(matrix)
    for point in random.uniform(-8, 8, 5):
        if np.abs(true - point).min() > 1e-6:
            assert above(matrix, point) == (true > point).sum()
    assert sum(count for *_, count in intervals(matrix, size)) == size


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(1 << 62), 1 << 62), min_size=3, max_size=3), min_size=1, max_size=6))
def test_products_are_exact(rows):
    found = exact_products(np.array(rows, dtype=np.int64))
    assert found == [[sum(r[i] * r[j] for r in rows) for j in range(3)] for i in range(3)]


def _usable(vector):
    return vector is not None and all(v is not None and math.isfinite(v) for v in vector)


def _brute(rows, components=16):
    """Exact sums in Python, eigenvectors by numpy."""
    xs = [(key, tuple(math.floor(64 * v) + 1_000_000 for v in vector)) for key, vector in rows]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    centred = np.array([[(n * v - s) / n for v, s in zip(x, sums)] for x in fit])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for key, x in xs:
        off = np.array([(n * v - s) / n for v, s in zip(x, sums)])
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        for c in range(len(values)):
            out.setdefault((key, c + 1), []).append((n, deviation, off @ vectors[:, c] / np.sqrt(values[c]), values[c] / np.trace(cov)))
    return out


def _same(found, expected):
    assert len(found) == sum(map(len, expected.values()))
    signs = {}
    by_key = {}
    for row in found:
        by_key.setdefault((row["vec_id"], row["component"]), []).append(row)
        assert row["identity_error"] <= 1e-9
    assert by_key.keys() == expected.keys()
    for key, rows in by_key.items():
        for row, (n, deviation, whitened, explained) in zip(sorted(rows, key=lambda r: r["deviation"]), sorted(expected[key], key=lambda r: r[1])):
            assert (row["n"], row["deviation"]) == (n, deviation)
            assert math.isclose(row["explained"], explained, rel_tol=1e-9)
            assert math.isclose(abs(row["whitened"]), abs(whitened), rel_tol=1e-7, abs_tol=1e-7)
            if abs(whitened) > 1e-3:
                assert signs.setdefault(key[1], row["whitened"] * whitened > 0) == (row["whitened"] * whitened > 0)


def test_given_embeddings(spark):
    frame = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect() if _usable(r["embedding"])]
    _same(whiten(frame).collect(), _brute(rows))


def test_odd_vectors(spark):
    random = np.random.default_rng(5)
    good = [(k, [float(v) for v in random.standard_normal(4) * (10, 3, 1, 0.3)]) for k in range(60)]
    # Repeated rows, vectors that differ by less than a step, repeated ids; what is dropped.
    good += good[:3] + [(7, [v + 1e-9 for v in good[0][1]])] + [(None, good[5][1])] * 30
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, math.nan, 2.0, 3.0]), (104, [math.inf, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [0.0] * 5)]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in good + bad], "vec_id long, embedding array<double>, n int, vector string, component int").repartition(4)
    found = whiten(frame).collect()
    _same(found, _brute(good, 4))
    nothing = frame.filter("false")
    assert whiten(nothing).count() == 0 and whiten(frame.filter("vec_id >= 100")).count() >= 0
    assert whiten(frame.filter("vec_id = 100")).count() == 0


def test_directions_without_variance(spark):
    one = [(k, [1.0, 2.0, 3.0]) for k in range(5)]
    assert whiten(spark.createDataFrame(one, "vec_id long, embedding array<float>")).count() == 0
    line = [(k, [float(k), 2.0 * k, 3.0]) for k in range(9)]
    found = whiten(spark.createDataFrame(line, "vec_id long, embedding array<float>")).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 9 and all(abs(r["explained"] - 1) < 1e-12 for r in found)


def test_large_entries(spark):
    rows = [(k, [3e9 * k, -7e8 * k * k, float(k)]) for k in range(1, 12)] + [(50, [1e300, -1e300, 0.0])]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 1).collect()
    # Deviations of these don't fit a 64-bit integer.
    assert len(found) == 12 and all(r["deviation"] is None and math.isfinite(r["whitened"]) for r in found)
    few = [(k, [3e5 * k, -7e3 * k * k, 64.0 * k]) for k in range(1, 12)]
    _same(whiten(spark.createDataFrame(few, "vec_id long, embedding array<double>"), 2).collect(), _brute(few, 2))
