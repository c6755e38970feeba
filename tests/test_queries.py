"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from factorloom import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_sql_has_queries():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_snapshot_is_symmetric(spark):
    rows = QUERIES["snapshot_json"](spark, SF).collect()
    corr = {(r["factor_a"], r["factor_b"]): r["corr"] for r in rows}
    assert corr and all(a != b and corr[b, a] == v for (a, b), v in corr.items())
