"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import DATA
from tests.oracle_check import ORACLES, QUERIES, assert_same, connect


@pytest.fixture(scope="module")
def database():
    return connect(DATA)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    assert_same(spark, database, name, DATA)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["customer_state", "revenue"] and frame.count() == 10
