"""Pages whose cells are cut short before they are taken apart."""

import re

from pyspark.sql import functions as F

from courtstats import fixed
from courtstats.catalog import season
from courtstats.functions.html import INNER, OUTER, nested_texts, short_cells, visible_html
from courtstats.plans.boxscore import STAT_ELEMENTS, name_rows, page_sides
from tests.markup import INFO, div, page, side, stats

ROWS = [stats(), stats(), stats()]


def short(spark, html):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(short_cells(F.col("html"), *STAT_ELEMENTS)).first()[0]


def texts(spark, html):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(nested_texts(F.col("html"), *STAT_ELEMENTS)).first()[0]


def row_of(*cells):
    return div(fixed.GROUP_CLASS, div(fixed.ROW_CLASS, "".join(cells)))


def test_page_is_left_without_cell_markup(spark):
    html = page("A", "B", INFO, side(["x", "y"], ROWS, False) * 2)
    got = short(spark, html)
    assert not re.search("|".join(STAT_ELEMENTS[1:]), got)
    assert len(got) < len(html) / 3


def test_cells_of_every_depth(spark):
    def cell(content):
        return div(fixed.CELL_CLASS, content)

    cells = [
        cell("1"), cell(""), cell("<div>2</div>"), cell("<div><div>3</div>4</div><div></div>5"),
        cell("<div><div><div>6</div></div></div>"), cell("<b>7</b>"), cell("a &amp; &#1;b"), cell("\u00018\u0003"),
    ]
    assert texts(spark, row_of(*cells)) == [[["1", "", "2", "345", "6", "7", "a & b", "8"]]]


def test_cells_that_do_not_end(spark):
    open_cell = f'<div class="{fixed.CELL_CLASS}">'
    html = row_of(open_cell, "1", div(fixed.CELL_CLASS, "2"), open_cell, "<div><div>3")
    assert texts(spark, html) == [[[None, "2", None]]]


def test_depths_and_marks_stay(spark):
    html = page("A", "B", INFO, side(["x", "y"], ROWS, False) * 2)
    df = spark.createDataFrame([(html,)], "html string").select(visible_html(F.col("html")).alias("html"))
    df = df.withColumn("short", short_cells(F.col("html"), *STAT_ELEMENTS))
    whole, cut = df.select(name_rows(F.col("html")), name_rows(F.col("short"), OUTER)).first()
    assert whole == cut == [["x", "y", "Total"]] * 2
    got = df.first().short
    assert got.count(OUTER) == 18 and got.count(INNER) == 2 * 3 * 20


def test_heading_that_holds_cells(spark):
    html = f'<h1 class="{fixed.CLUB_CLASS}">A {row_of(div(fixed.CELL_CLASS, "1"))}</h1>'
    sides = page_sides(spark.createDataFrame([(1, "22_23", html)], "page_id long, Season string, html string"))
    assert sides.first().Team == "A 1"


def test_last_cell_is_found_in_one_reading():
    """A look ahead at every cell would read the rest of the page each time."""
    patterns = [pattern for _, _, (pattern, _), _, _ in season.FAULTS]
    assert not any("(?!.*" in p for p in patterns)
