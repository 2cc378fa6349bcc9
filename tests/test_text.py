import itertools
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from courtstats.functions import html, text, values


@pytest.fixture
def one(spark):
    def evaluate(value, function, data_type="string"):
        df = spark.createDataFrame([(value,)], f"x {data_type}")
        return df.select(function(F.col("x")).alias("y")).first().y

    return evaluate


@pytest.mark.parametrize(
    "raw, expected",
    [("\t a b \n", "a b"), (" x  ", "x"), (" y", "y"), ("", ""), (None, None)],
)
def test_strip_text(one, raw, expected):
    assert one(raw, text.strip_text) == expected


def test_first_match_is_null_without_match(one):
    assert one("Round 17", lambda c: text.first_match(c, r"\d{1,2}")) == "17"
    assert one("none", lambda c: text.first_match(c, r"\d{1,2}")) is None
    assert one(None, lambda c: text.first_match(c, r"\d{1,2}")) is None


def test_match_groups_are_unanchored(one):
    def shots(c):
        return text.match_groups(c, r"(\d{1,2})/(\d{1,2})", ["a", "b"])

    assert tuple(one("100/120", shots)) == ("00", "12")
    assert tuple(one("x", shots)) == (None, None)


def test_start_anchor_only(one):
    assert one("/a/b?x", lambda c: text.starts_with_pattern(c, "/a|/c"))
    assert not one("x/a", lambda c: text.starts_with_pattern(c, "/a|/c"))


def test_blank_and_key(one, spark):
    assert one("", text.blank_to_zero) == "0"
    assert one(None, text.blank_to_zero) is None
    assert one("A", lambda c: text.concat_key(c, F.lit(12))) == "A12"
    assert one(None, lambda c: text.concat_key(c, F.lit(12))) is None


@pytest.mark.parametrize("raw, expected", [("10:05", 605), ("DNP", None), ("-1:30", 90), (None, None)])
def test_clock(one, raw, expected):
    assert one(raw, values.clock_to_seconds) == expected


@pytest.mark.parametrize("raw, expected", [("54.5%", 0.545), ("100%", 1.0), ("-", None), ("66.67%", 0.6667)])
def test_percent(one, raw, expected):
    got = one(raw, values.percent_to_ratio)
    assert (None if got is None else float(got)) == expected


def test_strict_and_lenient_numbers(one):
    assert one("7", values.to_number) == 7
    assert one("x", lambda c: values.to_number(c, strict=False)) is None
    with pytest.raises(PySparkException):
        one("", values.to_number)
    with pytest.raises(PySparkException):
        one("40000", values.to_number)
    assert one("", values.plus_minus) == 0
    assert one("-12", values.plus_minus) == -12


def test_dates(one):
    assert str(one("7 Oct 2022", values.parse_date)) == "2022-10-07"
    assert str(one(" 17 Jan 2023\n", values.parse_date)) == "2023-01-17"
    assert one("soon", lambda c: values.parse_date(c, strict=False)) is None
    with pytest.raises(PySparkException):
        one("soon", values.parse_date)


def test_rounds_and_seasons(one):
    assert [one(r, values.previous_round, "smallint") for r in (1, 2, 34)] == [1, 1, 33]
    assert one(2022, values.season_name, "int") == "22_23"
    assert one(2005, values.season_name, "int") == "5_6"
    assert one(2022, lambda c: values.season_name(c, "-"), "int") == "22-23"
    assert one(2022, values.season_site_label, "int") == "2022-23"
    assert one(2009, values.season_site_label, "int") == "2009-10"


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("a &amp; b", "a & b"),
        ("&amp;lt;", "&lt;"),
        ("&#39;&#x41;&#8364;&#128512;", "'A€😀"),
        ("&eacute;t&eacute;", "été"),
        ("a & b &nosuch; &amp", "a & b &nosuch; &amp"),
        ("&lt;b&gt;", "<b>"),
        ("plain", "plain"),
        ("", ""),
        (None, None),
    ],
)
def test_entities(one, raw, expected):
    assert one(raw, html.decode_entities) == expected


def test_visible_html(one):
    raw = "a<!-- <p> -->b<script>'<p>'</script>c<STYLE>p{}</style >d<scripty>"
    assert one(raw, html.visible_html) == "abcd<scripty>"


def test_element_texts(one):
    raw = (
        '<h1 class="a b">\n One <i>x</i>&amp; </h1><h1 id="1" class=\'b\'>Two</h1>'
        '<h1 class="bb">no</h1><h1 data-class="b">no</h1><H1 CLASS="c b">Three</H1>'
    )
    assert one(raw, lambda c: html.element_texts(c, "h1", "b")) == ["One x&", "Two", "Three"]
    assert len(one(raw, lambda c: html.element_texts(c, "h1"))) == 5


def test_two_class_names_match_the_exact_attribute(one):
    raw = '<div class="a b">1</div><div class="b a">2</div><div class="a b c">3</div>'
    assert one(raw, lambda c: html.element_texts(c, "div", "a b")) == ["1"]


def test_attribute_values(one):
    raw = """<a href="/x?a=1&amp;b=2">1</a><a name="n">2</a><a class='k' href='/y"z'>3</a><abbr href="/no">"""
    assert one(raw, lambda c: html.attribute_values(c, "a", "href")) == ["/x?a=1&b=2", '/y"z']
    assert one(raw, lambda c: html.attribute_values(c, "a", "href", "k")) == ['/y"z']


def test_child_fragments_counts_direct_children_only(one):
    raw = (
        'text<div>1<div>1a</div></div><p>between</p><div class="x">2</div> <div>3<div><div>'
        "3a</div></div></div></div><div>after the parent</div>"
    )
    kids = one(raw, html.child_fragments)
    assert len(kids) == 3
    assert kids[0].startswith("<div>1<div>1a") and kids[1].startswith('<div class="x">2')
    assert "3a" in kids[2] and "after" not in "".join(kids)
    assert one("no children</div><div>x</div>", html.child_fragments) == []


def test_part_before(one):
    opening = html.opening_tag("div", "g")
    assert one('a\n<div>b<div class="x g">c<div class="g">d', lambda c: html.part_before(c, opening)) == "a\n<div>b"
    assert one("no group\n", lambda c: html.part_before(c, opening)) == "no group\n"


def test_nested_texts(one):
    raw = (
        '<div class="c">lost</div><div class="g"><div class="r"></div><DIV class="a r b">'
        '<div class="c">1</div><div class="c k"><b>2</b>&amp;\x02</DIV ></div></div>'
        '<div class="g r2"><div class="r"><div class="cc">no</div><div class="c"></div></div></div>'
    )
    got = one(raw, lambda c: html.nested_texts(c, "div", "g", "r", "c"))
    assert got == [[[], ["1", "2&"]], [[""]]]


def test_tags_as_browsers_read_them(one):
    hrefs = lambda text: one(text, lambda c: html.attribute_values(c, "a", "href"))
    assert hrefs("<a href=/x/>y</a>") == ["/x/"]
    assert hrefs('<a title="a > b" href="/x/">y</a>') == ["/x/"]
    assert hrefs("<a title=' href=\"no\" ' data-href='n' HREF = '/q'>y</a>") == ["/q"]
    assert hrefs('<a href="">y</a><a class=b>z</a><abbr href="n">') == [""]
    texts = lambda text, name: one(text, lambda c: html.element_texts(c, "h1", name))
    assert texts("<h1 class=big>A</h1><h1 class='x big'>B</h1><h1 class=bigger>C</h1>", "big") == ["A", "B"]
    assert texts('<h1 title="class=big > x">A</h1><h1 data-x="1 > 0" class="big">B</h1>', "big") == ["B"]
    assert one("&lbrack;&hearts;&amp;&nosuch;&#x41;", html.decode_entities) == "[♥&&nosuch;A"


def test_elements_inside_a_cell(one):
    raw = (
        '<div class="g"><div class="r"><div class="c"><div>1</div><div>2</div></div>'
        '<div class="c">a<div><div>b</div>c</div>d</div> no <div>no</div><div class="c">e</div></div></div>'
    )
    assert one(raw, lambda c: html.nested_texts(c, "div", "g", "r", "c")) == [[["12", "abcd", "e"]]]


def test_a_cell_that_does_not_end_is_null(one):
    texts = lambda raw: one(raw, lambda c: html.nested_texts(c, "div", "g", "r", "c"))
    row = '<div class="g"><div class="r"><div class="c">1{}<div class="c">2</div></div></div>'
    assert texts(row.format("</div>")) == [[["1", "2"]]]
    assert texts(row.format("")) == [[[None, "2"]]]
    assert texts(row.format("<div>")) == [[[None, "2"]]]
    assert texts('<div class="g"><div class="r"><div class="c">1<div>') == [[[None]]]


def test_running_sum(spark):
    rows = [([],), ([5],), ([1, -1] * 40 + [3],), (list(range(300)),)]
    df = spark.createDataFrame(rows, "v array<int>").select("v", html.running_sum(F.col("v")).alias("s"))
    for r in df.collect():
        assert r.s == list(itertools.accumulate(r.v))


def test_many_tags_take_linear_time(spark):
    """Ten times the tags take at most about ten times as long."""

    def seconds(n):
        raw = f"{'<div>' * 50}{'</div>' * 50}" + "<div><b>x</b><div>y</div></div>" * (n // 4) + "</div>no"
        df = spark.createDataFrame([(raw,)], "raw string").select(html.child_fragments(F.col("raw")).alias("kids"))
        kids = df.collect()[0].kids
        assert len(kids) == n // 4 + 1 and kids[-1] == "<div><b>x</b><div>y</div></div>"
        start = time.perf_counter()
        df.collect()
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(10_000) < 40 * max(min(seconds(1000) for _ in range(3)), 0.05)
