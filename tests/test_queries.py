"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import database, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    assert differences(spark, con, SF, entry.queries()[name], entry.oracle_sql().get(name)) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
