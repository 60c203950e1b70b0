"""Every query with an SQL twin must give the same rows; the others must give some."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf).toPandas(), con.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, sf, name):
    assert len(QUERIES[name](spark, sf).toPandas()) > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


# operators of the survey, by id
SURVEY_IDS = [f"{area}{i}" for area, n in (
    ("s", 7), ("p", 12), ("j", 4), ("a", 13), ("w", 9), ("o", 5), ("u", 1), ("f", 21), ("m", 20), ("i", 15), ("t", 7),
    ("x", 6), ("v", 5), ("g", 2)) for i in range(1, n + 1)]


@pytest.mark.parametrize("operator", SURVEY_IDS)
def test_every_operator_has_a_query(operator):
    assert any(name.split("_")[0] == operator for name in QUERIES)
