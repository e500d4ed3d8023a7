"""Small tables with the cases that every operator has to define."""

from __future__ import annotations

import pytest

FOLDER = "/root/testdata/sf0.001"

# Nulls, empty and blank texts, repeated rows and ids, a long text, and clashing extra columns.
ODD_TEXTS = [
    (None, None), (None, "a text without an id"), (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (4, "one two three"),
    (5, "a\nb\na\n" * 30), (6, "wörd " * 20_000), (7, "x" * 30_000), (7, "another text of the same id"), (8, "héllo <|endoftext|> 漢字   don't"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(key, text, "en", "s", 0, 1, 2, "k", True, "x", 1.0) for key, text in ODD_TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n long, bucket int, tid string, kept boolean, shingle string, score double"
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")
