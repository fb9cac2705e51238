"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_points
from tideline.suite import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert differences(df, con, ORACLES[name]) is None


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert [r["status"] for r in rows] == ["PASSED", "PASSED"]
