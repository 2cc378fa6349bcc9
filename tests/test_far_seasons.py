"""Queries on game pages, with customer keys whose seasons have years of five digits."""

import duckdb
import pytest

from courtstats.catalog import ORACLES, QUERIES
from courtstats.catalog.games import games
from courtstats.sources.tables import with_page_season
from tests.test_oracles import rows_of

#: The first game of the season 10000 in the order of customer keys.
FIRST = 8000 * 408


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("far"))
    keys = spark.range(FIRST - 36, FIRST + 36)
    keys.selectExpr("id as c_custkey", "id % 1000 - 0.25D as c_acctbal").write.parquet(f"{path}/customer.parquet")
    return path


def test_games_stand_on_both_sides(spark, folder):
    assert {r.year for r in games(spark, folder).select("year").distinct().collect()} == {9999, 10000}


def test_links_name_seasons_of_any_year(spark):
    years = ["E2022", "E9999", "E10000", "E123456789", "E1234567890", "E99", "E"]
    pages = spark.createDataFrame([(f"/a-b/{y}/7/",) for y in years], "url string")
    got = [r.Season for r in with_page_season(pages).collect()]
    assert got == ["22_23", "7999_8000", "8000_8001", "123454789_123454790", None, None, None]


@pytest.mark.parametrize("name", ["boxscore_from_pages", "player_running_averages", "season_features", "team_running_averages", "unmatched_teams"])
def test_query(spark, folder, name):
    df = QUERIES[name](spark, folder)
    duck = duckdb.connect()
    duck.execute(f"create view customer as from '{folder}/customer.parquet/*.parquet'")
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    assert expected and rows_of(df.columns, df.collect()) == expected
