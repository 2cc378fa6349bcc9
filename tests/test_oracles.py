"""Every query against its SQL on DuckDB, at the smallest scale."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from courtstats.catalog import QUERIES
from courtstats.catalog.tables import FACT_ORDER, fact

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(
    not os.path.isdir(SF_DIR), reason="the given tables are not here"
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as from '{SF_DIR}/{file}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value) if isinstance(value, float) else str(value)


def rows_of(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = rows_of(columns, result.fetchall())
    assert rows_of(df.columns, df.collect()) == expected


def test_entry(spark):
    assert entry(spark).count() > 0


def test_order_of_player_rows_has_no_ties(spark):
    rows = fact(spark, SF_DIR)
    assert rows.groupBy("player", *FACT_ORDER).count().where("count > 1").isEmpty()


@pytest.mark.parametrize("name", ["full_features", "lagged_team_join"])
def test_line_items_are_joined_once(spark, name):
    """What the query returns reads the joined rows from the staged table."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "o_custkey" not in plan and "c_custkey" not in plan
