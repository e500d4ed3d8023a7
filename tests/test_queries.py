"""Every registered query against its reference SQL on the smallest tables."""

import pytest

from lodegate.plans import load_queries
from tests.compare import compare, reference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return reference(FOLDER)


@pytest.mark.parametrize("name", sorted(load_queries()))
def test_query_equals_reference(spark, connection, name):
    assert compare(spark, FOLDER, name, connection) == ""
