"""Every query against its SQL twin in DuckDB, row for row."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry_points

ORACLE = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, sf_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
