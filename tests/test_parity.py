"""Every registered query against its SQL twin; PARITY_SF_DIR picks the tables."""

import os

import pytest

from parity import compare
from parity.oracle import oracle_sql
from parity.queries import QUERIES

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(oracle_sql()) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    assert compare.differences(spark, duck, name, SF_DIR) == []
