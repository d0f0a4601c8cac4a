"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from catalog.registry import QUERIES as REGISTER
from compare import check, connection

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# The facts that these state about learners need more rows than the smallest tables have.
LARGER = {"importance_selection", "algorithm_bakeoff", "nested_model_comparison"}


@pytest.fixture(scope="module")
def sql():
    return connection(FOLDER)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in REGISTER])
def test_query(spark, sql, name):
    folder = "/root/testdata/sf0.01" if name in LARGER else FOLDER
    con = connection(folder) if name in LARGER else sql
    verdict, _, note = check(spark, con, folder, name, QUERIES[name], ORACLES[name])
    assert verdict in ("exact", "close"), f"{verdict}: {note}"


@pytest.mark.parametrize("name, columns", [("sort_rows", 3), ("custom_order", 1), ("top_features", 2), ("point_lookup_sorted", 4)])
def test_order_of_rows(spark, sql, name, columns):
    """The SQL of these queries ends in ORDER BY; the leading columns must come in that order."""
    df = QUERIES[name](spark, FOLDER)
    names = df.columns[:columns]
    got = [tuple(str(r[c]) for c in names) for r in df.collect()]
    relation = sql.sql(ORACLES[name])
    place = [list(relation.columns).index(c) for c in names]
    assert got == [tuple(str(r[i]) for i in place) for r in relation.fetchall()]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
