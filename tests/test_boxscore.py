from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from courtstats import fixed
from courtstats.plans.boxscore import boxscore, game_info, rejected_sides
from courtstats.plans.links import collect_links, page_links, player_links, season_game_link
from courtstats.sources.tables import with_page_season
from tests.markup import INFO, page, side, stats

URL = "/euroleague/game-center/2022-23/a-b/E2022/{}/"


def pages(spark, *htmls):
    rows = [(i, URL.format(i), h) for i, h in enumerate(htmls)]
    return with_page_season(
        spark.createDataFrame(rows, "page_id long, url string, html string")
    )


def good_page():
    home = side(
        ["smith-j", "doe"],
        [stats("DNP", "0", plus_minus=""), stats("10:05", "7"), stats("", "1"), stats("200:00", "80")],
        team_row=True,
    )
    away = side(
        ["lee", "kim", "o-neil"],
        [stats(points=str(p)) for p in (1, 2, 3)] + [stats("200:00", "60", plus_minus="-20")],
        team_row=False,
    )
    return page("Ñandú", "A &amp; B", INFO, home + away)


def test_golden_page(spark):
    df = boxscore(pages(spark, good_page()))
    assert df.columns == [*fixed.BOXSCORE_COLUMNS, "Season"]
    assert len(fixed.BOXSCORE_COLUMNS) == 30
    rows = {(r.Team, r.Player): r for r in df.collect()}
    assert set(rows) == {
        ("Ñandú", "smith-j"), ("Ñandú", "doe"), ("Ñandú", "Total"),
        ("A & B", "lee"), ("A & B", "kim"), ("A & B", "o-neil"), ("A & B", "Total"),
    }
    smith, doe = rows["Ñandú", "smith-j"], rows["Ñandú", "doe"]
    assert (smith.Seconds, smith.Points, smith.PlusMinus) == (None, 0, 0)
    assert (doe.Seconds, doe.Points, doe.Opponent, doe.Home) == (605, 7, "A & B", True)
    assert (doe.TwoPMakes, doe.TwoPAttempts) == ("1", "2")
    assert doe["3P_Percentage"] == Decimal("0.6670")
    assert [doe[c] for c in fixed.BOXSCORE_COLUMNS[12:23]] == list(range(1, 12))
    assert (str(doe.Date), doe.Round, doe.GameTime, doe.Season) == (
        "2022-10-07", "7", "20:00", "22_23"
    )
    total = rows["A & B", "Total"]
    assert (total.Points, total.PlusMinus, total.Home, total.Opponent) == (60, -20, False, "Ñandú")


def test_page_without_statistics_gives_no_rows(spark):
    empty = page("A", "B", INFO, "")
    df = pages(spark, empty, good_page())
    assert boxscore(df).count() == 7
    assert game_info(df).count() == 2
    assert rejected_sides(df).count() == 0


@pytest.mark.parametrize(
    "body, problem",
    [
        (side(["a", "b"], [stats(), stats()], False) + side(["c"], [stats(), stats()], False),
         "names and rows differ in number"),
        (side(["a"], [stats(), stats()[:-1]], False) + side(["c"], [stats(), stats()], False),
         "rows do not hold all statistics"),
    ],
)
def test_page_that_does_not_fit(spark, body, problem):
    df = pages(spark, page("A", "B", INFO, body), good_page())
    assert problem in [r.problem for r in rejected_sides(df).collect()]
    with pytest.raises(PySparkException, match="page 0 " + problem):
        boxscore(df).collect()
    assert boxscore(df, strict=False).where("Season = '22_23'").count() >= 7


def test_bad_number_raises_or_is_null(spark):
    bad = page(
        "A", "B", INFO,
        side(["a"], [stats(points="x"), stats()], False) + side(["b"], [stats(), stats()], False),
    )
    with pytest.raises(PySparkException):
        boxscore(pages(spark, bad)).collect()
    points = [r.Points for r in boxscore(pages(spark, bad), strict=False).collect()]
    assert sorted(points, key=str) == [5, 5, 5, None]


def test_no_shuffle_from_page_to_rows(spark):
    plan = boxscore(pages(spark, good_page()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_links(spark):
    listing = (
        '<a href="/euroleague/game-center/2022-23/x-y/E2022/7/">a</a><a href="/news">n</a>'
        '<a href="/euroleague/game-center/2022-23/x-y/E2022/7/#tab">b</a>'
        '<a href="https://x/euroleague/game-center/2022-23/x-y/E2022/8/">c</a>'
    )
    df = spark.createDataFrame(
        [(2, listing), (1, listing.replace("E2022/7", "E2022/9"))], "page_id long, html string"
    )
    assert page_links(df).count() == 8
    found = {r.href: (r.page_id, r.position) for r in collect_links(df).collect()}
    base = "/euroleague/game-center/2022-23/x-y/E2022/"
    assert collect_links(df, season_game_link(2022)).count() == 4
    assert collect_links(df, season_game_link(2009)).count() == 0
    assert found == {
        base + "7/": (2, 0), base + "7/#tab": (2, 2), base + "9/": (1, 0), base + "9/#tab": (1, 2)
    }


def test_player_links(spark):
    got = player_links(pages(spark, good_page())).orderBy("position").collect()
    assert [r.names for r in got] == ["smith-j", "doe", "lee", "kim", "o-neil"]
    assert got[0].links == "/euroleague/players/smith-j/000/"
