import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtstats import fixed
from courtstats.operators.explore import head, pearson_corr, scatter_points, schema_table, shape
from courtstats.operators.reshape import (
    label_at,
    labels_of,
    ordered_distinct,
    pivot_wide,
    transpose,
    union_all,
    unpivot_long,
)
from courtstats.plans import season
from courtstats.plans.boxscore import boxscore
from courtstats.plans.season import run_seasons
from courtstats.sources import publish
from courtstats.sources.shared import shared_folder, stage
from courtstats.sources.tables import (
    read_season,
    read_season_sheets,
    read_sheet,
    sheet_schema,
    write_seasons,
    write_sheet,
)
from tests.markup import INFO, page, side, stats


def test_stage_reads_back_the_same_rows(spark):
    df = spark.range(10).selectExpr("id", "cast(id as decimal(9,4)) as d", "date'2022-01-01' as `a b%`")
    stored = stage(df, "t")
    assert stored.dtypes == df.dtypes and sorted(stored.collect()) == sorted(df.collect())


def test_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_one_season_is_pruned(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "concat(id % 3, '_', id % 3 + 1) as Season")
    write_seasons(df, str(tmp_path / "s"))
    one = read_season(spark, str(tmp_path / "s"), "1_2")
    assert one.count() == 33
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Season" in plan


def test_sheet_reads_only_needed_columns(spark, tmp_path):
    row = ("A", *[float(i) for i in range(16)], "note")
    schema = sheet_schema(["NOTE"])
    write_sheet(spark.createDataFrame([row], schema), str(tmp_path / "one"))
    got = read_sheet(spark, str(tmp_path / "one"), schema)
    assert tuple(got.first()) == row and got.schema == schema
    plan = got.select("TEAM", "PACE")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<TEAM:string,PACE:string>" in plan


def test_sheet_folders_hold_one_file_each(spark, tmp_path):
    """However many tasks have rows of a season."""
    rows = spark.range(0, 600, 1, 6).selectExpr("concat('T', id) as TEAM", "id % 5 as PACE", "concat(id % 3, '_x') as Season")
    write_sheet(rows, str(tmp_path / "s"), "Season")
    files = [len([f for f in os.listdir(tmp_path / "s" / d) if f.endswith(".csv")]) for d in os.listdir(tmp_path / "s") if "=" in d]
    assert files == [1, 1, 1]
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).distinct().count() == 600


def test_run_seasons(spark, tmp_path):
    """Pages and sheets in, season folders out; a second run gives the same."""
    pages = []
    for season in (2022, 2023):
        for n, (home, away) in enumerate([("A", "B"), ("B", "A")], start=1):
            body = side([f"p-{home}"], [stats(), stats("200:00", "80")], False)
            body += side([f"p-{away}"], [stats(), stats("200:00", "60")], False)
            info = [f"Round {n}", f"{n} Oct {season}", "x", "20:00"]
            url = f"/euroleague/game-center/{season}-{season % 100 + 1}/a-b/E{season}/{n}/"
            pages.append((len(pages), url, page(home, away, info, body)))
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(
        str(tmp_path / "pages")
    )
    sheet = [(t, *[1.0] * 16, s) for t in "AB" for s in ("22_23", "23_24")]
    fields = "TEAM string, " + ", ".join(f"`{c}` double" for c in fixed.SHEET_STATS)
    write_sheet(
        spark.createDataFrame(sheet, fields + ", Season string"), str(tmp_path / "sheets"), "Season"
    )
    assert read_season_sheets(spark, str(tmp_path / "sheets")).count() == 4
    paths = [str(tmp_path / p) for p in ("pages", "sheets", "raw", "out")]
    first = run_seasons(spark, *paths)
    rows = sorted(map(str, first.collect()))
    assert len(rows) == 8 and len(first.columns) == 132
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    again = run_seasons(spark, *paths)
    assert set(os.listdir(folder)) == before
    assert sorted(map(str, again.collect())) == rows
    assert spark.read.parquet(paths[2]).count() == 16


def test_run_of_one_season_keeps_the_others(spark, tmp_path):
    def pages(season, name, points):
        body = side(["p-A"], [stats(), stats("200:00", points)], False)
        body += side(["p-B"], [stats(), stats("200:00", "60")], False)
        row = (1, "/no/season/", page("A", "B", ["Round 1", f"1 Oct {season}", "x", "20:00"], body))
        path = str(tmp_path / name)
        spark.createDataFrame([row], "page_id long, url string, html string").write.parquet(path)
        return path

    sheet = [(t, *[1.0] * 16, s) for t in "AB" for s in ("22_23", "23_24")]
    fields = "TEAM string, " + ", ".join(f"`{c}` double" for c in fixed.SHEET_STATS)
    sheets, raw, out = (str(tmp_path / p) for p in ("sheets", "raw", "out"))
    write_sheet(spark.createDataFrame(sheet, fields + ", Season string"), sheets, "Season")
    run_seasons(spark, pages(2022, "a", "80"), sheets, raw, out, 2022)
    one = run_seasons(spark, pages(2023, "b", "81"), sheets, raw, out, 2023)
    assert {r.Season for r in one.collect()} == {"23_24"}
    kept = spark.read.parquet(raw).groupBy("Season").count().collect()
    assert {r.Season for r in kept} == {"22_23", "23_24"}
    run_seasons(spark, pages(2023, "c", "99"), sheets, raw, out, 2023)
    points = {r.Season: r.p for r in spark.read.parquet(raw).groupBy("Season").agg(F.max("Points").alias("p")).collect()}
    assert points == {"22_23": 80, "23_24": 99}
    with pytest.raises(Exception, match="no season in the link"):
        run_seasons(spark, pages(2023, "d", "99"), sheets, raw, out)


def test_run_reports_what_it_leaves_out(spark, tmp_path):
    def url(n):
        return f"/euroleague/game-center/2022-23/a-b/E2022/{n}/"

    info = ["Round 1", "1 Oct 2022", "x", "20:00"]
    good = side(["p-A"], [stats(), stats("200:00", "80")], False) + side(["p-B"], [stats(), stats("200:00", "60")], False)
    bad = side(["p-A", "p-Z"], [stats(), stats("200:00", "80")], False)
    pages = [(1, url(1), page("A", "B", info, good)), (2, url(2), page("A", "B", info, bad)), (3, "/x/", page("A", "B", info, good))]
    path = lambda name: str(tmp_path / name)
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(path("pages"))
    fields = "TEAM string, " + ", ".join(f"`{c}` double" for c in fixed.SHEET_STATS)
    write_sheet(spark.createDataFrame([("A", *[1.0] * 16, "22_23")], fields + ", Season string"), path("sheets"), "Season")
    run_seasons(spark, path("pages"), path("sheets"), path("raw"), path("out"), strict=False, rejects_path=path("no"))
    sides = spark.read.parquet(path("no/sides"))
    assert {(r.page_id, r.problem) for r in sides.collect()} == {
        (2, "names and rows differ in number"),
        (2, "rows do not hold all statistics"),
        (3, "the link names no season"),
    }
    teams = spark.read.parquet(path("no/teams")).select("Season", "Team")
    assert [tuple(r) for r in teams.collect()] == [("22_23", "B")]
    twice = [(1, url(1), pages[0][2]), (2, url(2), pages[0][2])]
    spark.createDataFrame(twice, "page_id long, url string, html string").write.parquet(path("two"))
    with pytest.raises(ValueError, match="several total rows"):
        run_seasons(spark, path("two"), path("sheets"), path("raw"), path("out"))


URL = "/euroleague/game-center/{0}-{1}/a-b/E{0}/{2}/"


def season_pages(spark, path, season, points=("80",), more=()):
    rows = []
    for n, p in enumerate(points, start=1):
        body = side(["p-A"], [stats(), stats("200:00", p)], False) + side(["p-B"], [stats(), stats("200:00", "60")], False)
        rows.append((n, URL.format(season, season % 100 + 1, n), page("A", "B", [f"Round {n}", f"{n} Oct {season}", "x", "20:00"], body)))
    rows += more
    spark.createDataFrame(rows, "page_id long, url string, html string").write.mode("overwrite").parquet(path)
    return path


@pytest.fixture
def folders(spark, tmp_path):
    sheet = [(t, *[1.0] * 16, s) for t in "AB" for s in ("22_23", "23_24")]
    fields = "TEAM string, " + ", ".join(f"`{c}` double" for c in fixed.SHEET_STATS)
    write_sheet(spark.createDataFrame(sheet, fields + ", Season string"), str(tmp_path / "sheets"), "Season")
    return lambda name: str(tmp_path / name)


def max_points(spark, path):
    rows = spark.read.parquet(path).groupBy("Season").agg(F.max("Points").alias("p")).collect()
    return {r.Season: r.p for r in rows}


def test_repeated_totals_are_left_out_and_listed(spark, folders):
    twice = season_pages(spark, folders("pages"), 2022, ["80", "81"])
    rows = spark.read.parquet(twice)
    rows = rows.union(rows.where("page_id = 2").withColumn("page_id", F.lit(9).cast("long")))
    rows.write.parquet(folders("three"))
    out = run_seasons(
        spark, folders("three"), folders("sheets"), folders("raw"), folders("out"), strict=False, rejects_path=folders("no")
    )
    listed = {(r.Season, r.Team, r.Round, r.n_rows) for r in spark.read.parquet(folders("no/totals")).collect()}
    assert listed == {("22_23", "A", "2", 2), ("22_23", "B", "2", 2)}
    raw = spark.read.parquet(folders("raw"))
    assert sorted((r.Player, r.Round) for r in raw.where("Player = 'Total'").collect()) == [("Total", "1")] * 2
    # Round 1 meets its own totals and so does round 2: no row is multiplied.
    assert out.groupBy("Player", "Round").count().where("count > 2").isEmpty()


def test_bad_numbers_and_links_are_listed(spark, folders):
    body = side(["p-A"], [stats(points="x1"), stats("200:00", "80")], False) + side(["p-B"], [stats(), stats()], False)
    info = ["Round 3", "3 Oct 2022", "x", "20:00"]
    more = [(5, URL.format(2022, 23, 5), page("A", "B", info, body)), (6, "/x/", page("A", "B", info, body))]
    pages = season_pages(spark, folders("pages"), 2022, more=more)
    args = pages, folders("sheets"), folders("raw"), folders("out")
    run_seasons(spark, *args, strict=False, rejects_path=folders("no"))
    values = spark.read.parquet(folders("no/values")).collect()
    assert [(r.page_id, r.Home, r.Player, r.stat, r.value, r.Season) for r in values] == [
        (5, True, "p-A", "Points", "x1", "22_23")
    ]
    sides = spark.read.parquet(folders("no/sides")).collect()
    assert [(r.page_id, r.problem, r.Season) for r in sides] == [(6, "the link names no season", None)] * 2


def test_rejects_of_other_seasons_stay(spark, folders):
    bad = side(["p-A", "p-Z"], [stats(), stats("200:00", "80")], False)

    def run(season, more):
        pages = season_pages(spark, folders(f"pages{season}{len(more)}"), season, more=more)
        run_seasons(
            spark, pages, folders("sheets"), folders("raw"), folders("out"), season, strict=False, rejects_path=folders("no")
        )
        found = spark.read.schema("page_id long, Season string").parquet(folders("no/sides")).distinct()
        return {(r.page_id, r.Season) for r in found.collect()}

    faulty = [(7, "/x/", page("A", "B", ["Round 4", "4 Oct 2022", "x", "20:00"], bad))]
    assert run(2022, faulty) == {(7, "22_23")}
    assert run(2023, faulty) == {(7, "22_23"), (7, "23_24")}
    assert run(2022, []) == {(7, "23_24")}


@pytest.mark.parametrize("at", ["features", "journal"])
def test_a_run_that_fails_leaves_the_earlier_state(spark, folders, monkeypatch, at):
    args = folders("sheets"), folders("raw"), folders("out")
    run_seasons(spark, season_pages(spark, folders("a"), 2022), *args)
    before = sorted(map(str, spark.read.parquet(folders("out")).collect()))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if at == "journal":
            patch.setattr(publish, "_write", fail)
        else:
            patch.setattr(season, "season_features", lambda box, sheets: box.withColumn("x", F.raise_error(F.lit("lost"))))
        with pytest.raises(Exception, match="lost"):
            run_seasons(spark, season_pages(spark, folders("b"), 2022, ["99"]), *args)
    assert max_points(spark, folders("raw")) == {"22_23": 80}
    assert sorted(map(str, spark.read.parquet(folders("out")).collect())) == before
    assert not [n for f in ("raw", "out") for n in os.listdir(folders(f)) if n.startswith("_new")]


@pytest.mark.parametrize("moves", [0, 1])
def test_a_step_that_was_broken_off_is_finished(spark, folders, monkeypatch, moves):
    args = folders("sheets"), folders("raw"), folders("out")
    run_seasons(spark, season_pages(spark, folders("a"), 2022), *args)
    left, move = [moves], publish._move

    def some(*names):
        if not left[0]:
            raise OSError("lost")
        left[0] -= 1
        move(*names)

    with monkeypatch.context() as patch:
        patch.setattr(publish, "_move", some)
        with pytest.raises(OSError):
            run_seasons(spark, season_pages(spark, folders("b"), 2022, ["99"]), *args)
    publish.finish(spark, folders("out"))
    assert max_points(spark, folders("raw")) == {"22_23": 99}
    assert spark.read.parquet(folders("out")).count() == 2
    assert not [n for f in ("raw", "out") for n in os.listdir(folders(f)) if n.startswith(("_new", "_publish"))]


def test_sheets_with_a_header_of_their_own(spark, tmp_path):
    folder = str(tmp_path / "a b%20c")
    schema = T.StructType([T.StructField("TEAM", T.StringType()), T.StructField("PACE", T.DoubleType())])
    one = spark.createDataFrame([("A", "x", 1.5)], "TEAM string, note string, PACE double")
    write_sheet(one, folder + "/Season=21_22")
    write_sheet(one.select("PACE", "TEAM"), folder + "/Season=22_23")
    got = read_season_sheets(spark, folder, schema)
    assert sorted(map(tuple, got.collect())) == [("A", 1.5, "21_22"), ("A", 1.5, "22_23")]
    assert [tuple(r) for r in got.where("Season = '22_23'").collect()] == [("A", 1.5, "22_23")]
    write_sheet(one.select("PACE"), folder + "/Season=23_24")
    with pytest.raises(ValueError, match="no column TEAM"):
        read_season_sheets(spark, folder, schema)


def test_labels_come_from_the_data(spark):
    rows = [(1, "b", 1.0, 2.0), (1, "a", 3.0, 4.0), (2, "a", 5.0, None), (2, None, 6.0, 7.0)]
    df = spark.createDataFrame(rows, "k int, name string, x double, y double")
    got = transpose(df, ["k"], "name", ["x", "y"], "stat")
    assert got.columns == ["k", "stat", "a", "b"]
    assert sorted(map(tuple, got.collect()), key=str) == [
        (1, "x", 3.0, 1.0), (1, "y", 4.0, 2.0), (2, "x", 5.0, None), (2, "y", None, None)
    ]
    many = spark.range(30).selectExpr("id as k", "cast(id as string) as name", "1.0 as x")
    with pytest.raises(ValueError, match="more than 20 different"):
        labels_of(many, "name", 20)
    assert transpose(df.limit(0), ["k"], "name", ["x"], "stat").columns == ["k", "stat"]


def test_sheet_columns_are_taken_by_name(spark, tmp_path):
    rows = spark.createDataFrame([("5", "x", "A", "1.5"), ("bad", "y", "B", None)], "GP string, z string, TEAM string, PACE string")
    write_sheet(rows, str(tmp_path / "s"))
    schema = T.StructType([T.StructField("TEAM", T.StringType()), T.StructField("PACE", T.DoubleType())])
    got = read_sheet(spark, str(tmp_path / "s"), schema)
    assert sorted(map(tuple, got.collect())) == [("A", 1.5), ("B", None)]
    with pytest.raises(ValueError, match="no column BLK%"):
        read_sheet(spark, str(tmp_path / "s"), T.StructType([T.StructField("BLK%", T.DoubleType())]))
    number = T.StructType([T.StructField("GP", T.DoubleType())])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_sheet(spark, str(tmp_path / "s"), number).collect()
    loose = read_sheet(spark, str(tmp_path / "s"), number, strict=False)
    assert {r.GP for r in loose.collect()} == {5.0, None}


def test_value_without_a_label_raises(spark):
    long = spark.createDataFrame([(1, "a", 2), (1, "c", 3), (2, None, 4)], "k int, name string, value int")
    with pytest.raises(Exception, match="not a label of name: c"):
        pivot_wide(long, ["k"], "name", "value", ["a", "b"]).collect()
    with pytest.raises(Exception, match="no label for position 2"):
        spark.range(3).select(label_at(["x", "y"], F.col("id").cast("int"))).collect()


def test_union_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert sorted(map(tuple, union_all(a, b, a).collect())) == [(1, "x"), (1, "x"), (2, "y")]


def test_long_and_wide_are_inverse(spark):
    df = spark.createDataFrame([(1, 10, 20), (2, None, 40)], "k int, a int, b int")
    long = unpivot_long(df, ["k"], ["a", "b"], "name", "value")
    assert long.count() == 4
    wide = pivot_wide(long, ["k"], "name", "value", ["a", "b"])
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, df.collect()))


def test_transpose(spark):
    df = spark.createDataFrame(
        [(1, "Points", "5", "7"), (1, "Steals", "1", "2")], "g int, Stat string, ann string, bo string"
    )
    got = transpose(df, ["g"], "Stat", ["ann", "bo"], "Player", ["Points", "Steals"])
    assert sorted(map(tuple, got.collect())) == [(1, "ann", "5", "1"), (1, "bo", "7", "2")]


def test_ordered_distinct_keeps_the_first(spark):
    df = spark.createDataFrame([("a", 2, 0), ("a", 1, 5), ("b", 1, 6)], "v string, page int, pos int")
    got = ordered_distinct(df.repartition(3), "v", ["page", "pos"])
    assert sorted(map(tuple, got.collect())) == [("a", 1, 5), ("b", 1, 6)]


def test_correlation(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 5), (2, 4.0, 5), (3, 6.5, 5), (None, 9.0, 5)], "x int, y double, z int"
    )
    assert pearson_corr(df, "x", "y", "c").first().c == pytest.approx(0.99794, abs=1e-4)
    assert pearson_corr(df, "x", "z", "c").first().c is None
    assert pearson_corr(df.limit(1), "x", "y", "c").first().c is None
    assert pearson_corr(df.limit(0), "x", "y", "c").first().c is None


def test_looking(spark):
    df = spark.createDataFrame([(i, None if i == 3 else i * 1.0) for i in range(7)], "id int, `AST/TO` double")
    assert tuple(shape(df).first()) == (7, 2)
    assert [tuple(r) for r in schema_table(df).collect()] == [
        (0, "id", "int", 7), (1, "AST/TO", "double", 7)
    ]
    assert [r.id for r in head(df.orderBy(F.desc("id")), ["id"]).collect()] == [0, 1, 2, 3, 4]
    assert scatter_points(df, "id", "AST/TO").count() == 6
