"""Text extraction on the given web pages."""

from pyspark.sql import functions as F

from courtstats.catalog.registry import query
from courtstats.catalog.tables import table
from courtstats.functions.html import element_texts, visible_html
from courtstats.functions.text import (
    first_match,
    match_groups,
    starts_with_pattern,
    strip_text,
)
from courtstats.operators.reshape import label_at, ordered_distinct
from courtstats.plans.boxscore import after_leading_rows, head_of, tail_of
from courtstats.plans.links import collect_links, page_links

# The visible part of a page, its links and its list items in DuckDB SQL.
VISIBLE_DUCK = (
    "visible as (select page_id, url, regexp_replace(html,"
    " '<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'gs') as html from pages)"
)
HREFS_DUCK = """hrefs as (select page_id, unnest(range(len(h))) as position, unnest(h) as href
  from (select page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) as h from visible) v)"""
ITEMS_DUCK = """items as (select page_id,
  list_transform(regexp_extract_all(html, '<li>(.*?)</li>', 1),
    lambda x: trim(regexp_replace(x, '<[^>]*>', '', 'g'))) as cells from visible)"""
# One label for each item a page of this kind can hold; more would raise.
LABELS = [f"item {i + 1}" for i in range(100)]
# A link that starts with an ASCII capital, anchored at the start only.
WORD_LINK = "/[A-Z][a-z]"


def _unescape(text):
    return (
        f"replace(replace(replace(replace({text}, '&quot;', '\"'), '&copy;', '©'),"
        " '&middot;', '·'), '&amp;', '&')"
    )


def items(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", element_texts(visible_html(F.col("html")), "li").alias("cells")
    )


@query("page_scan", "select page_id, url, html from pages")
def page_scan(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


@query("page_links", f"with {VISIBLE_DUCK}, {HREFS_DUCK} select page_id, position, href from hrefs")
def links(spark, sf_dir):
    found = page_links(table(spark, sf_dir, "pages"))
    return found.withColumn("position", F.col("position").cast("bigint"))


@query(
    "link_filter",
    f"""with {VISIBLE_DUCK}, {HREFS_DUCK} select page_id, position, href from hrefs
        where regexp_matches(href, '^{WORD_LINK}')""",
)
def link_filter(spark, sf_dir):
    return links(spark, sf_dir).where(starts_with_pattern(F.col("href"), WORD_LINK))


@query(
    "ordered_dedupe",
    f"""with {VISIBLE_DUCK}, {HREFS_DUCK}
        select href, min((page_id, position))[1] as page_id, min((page_id, position))[2] as position
        from hrefs group by href""",
)
def ordered_dedupe(spark, sf_dir):
    return ordered_distinct(links(spark, sf_dir), "href", ["page_id", "position"])


@query(
    "collect_links",
    f"""with {VISIBLE_DUCK}, {HREFS_DUCK}
        select href, min((page_id, position))[1] as page_id, min((page_id, position))[2] as position
        from hrefs where regexp_matches(href, '^{WORD_LINK}') group by href""",
)
def collected_links(spark, sf_dir):
    found = collect_links(table(spark, sf_dir, "pages"), WORD_LINK)
    return found.withColumn("position", F.col("position").cast("bigint"))


@query(
    "element_text",
    f"""with {VISIBLE_DUCK}
        select page_id, {_unescape("trim(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '<[^>]*>', '', 'g'))")} as heading,
               {_unescape("trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's'))")} as title,
               len(regexp_extract_all(html, '<h1>')) as n_headings from visible""",
)
def element_text(spark, sf_dir):
    html = F.col("html")
    texts = table(spark, sf_dir, "pages").select(
        "page_id",
        element_texts(visible_html(html), "h1").alias("h1"),
        element_texts(visible_html(html), "title").alias("t"),
    )
    return texts.select(
        "page_id",
        F.get("h1", F.lit(0)).alias("heading"),
        F.get("t", F.lit(0)).alias("title"),
        F.size("h1").cast("bigint").alias("n_headings"),
    )


@query(
    "page_cells",
    f"""with {VISIBLE_DUCK}, {ITEMS_DUCK}
        select page_id, unnest(range(len(cells))) as position, unnest(cells) as cell from items""",
)
def page_cells(spark, sf_dir):
    return items(spark, sf_dir).select(
        "page_id", F.posexplode("cells").alias("p", "cell")
    ).select("page_id", F.col("p").cast("bigint").alias("position"), "cell")


@query(
    "label_by_position",
    f"""with {VISIBLE_DUCK}, {ITEMS_DUCK}
        select page_id, cell, 'item ' || (position + 1) as label from (
          select page_id, unnest(range(len(cells))) as position, unnest(cells) as cell
          from items) a""",
)
def label_by_position(spark, sf_dir):
    cells = page_cells(spark, sf_dir)
    return cells.select(
        "page_id", "cell", label_at(LABELS, F.col("position").cast("int")).alias("label")
    )


@query(
    "array_slices",
    f"""with {VISIBLE_DUCK}, {ITEMS_DUCK}
        select page_id, len(cells[3:]) as n_after_leading,
               array_to_string(cells[:2], '|') as head_cells,
               array_to_string(cells[3:], '|') as tail_cells from items""",
)
def array_slices(spark, sf_dir):
    cells = F.col("cells")
    two = F.lit(2)
    return items(spark, sf_dir).select(
        "page_id",
        F.size(after_leading_rows(cells)).cast("bigint").alias("n_after_leading"),
        F.array_join(head_of(cells, two), "|").alias("head_cells"),
        F.array_join(tail_of(cells, two), "|").alias("tail_cells"),
    )


@query(
    "regex_extract",
    r"""select page_id, nullif(regexp_extract(url, '\d{1,2}'), '') as first_number,
               nullif(regexp_extract(url, 'page=([\d.]+)', 1), '') as page_number from pages""",
)
def regex_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        first_match(F.col("url"), r"\d{1,2}").alias("first_number"),
        first_match(F.col("url"), r"page=([\d.]+)", 1).alias("page_number"),
    )


@query(
    "extract_groups",
    r"""select page_id,
               case when regexp_matches(url, '/([a-z]{2})/(\d+)[/.]')
                    then regexp_extract(url, '/([a-z]{2})/(\d+)[/.]', 1) end as lang,
               case when regexp_matches(url, '/([a-z]{2})/(\d+)[/.]')
                    then regexp_extract(url, '/([a-z]{2})/(\d+)[/.]', 2) end as number
        from pages""",
)
def extract_groups(spark, sf_dir):
    groups = match_groups(F.col("url"), r"/([a-z]{2})/(\d+)[/.]", ["lang", "number"])
    return table(spark, sf_dir, "pages").select("page_id", groups.alias("g")).select(
        "page_id", "g.*"
    )


@query(
    "strip_text",
    r"""select page_id, regexp_replace(regexp_replace(
          '  ' || chr(160) || chr(9) || html || chr(10) || '  ' || url || chr(160) || ' ',
          '^[\s\x{00a0}]+', ''), '[\s\x{00a0}]+$', '') as stripped from pages""",
)
def strip(spark, sf_dir):
    padded = F.concat(
        F.lit("   \t"), "html", F.lit("\n  "), "url", F.lit("  ")
    )
    return table(spark, sf_dir, "pages").select(
        "page_id", strip_text(padded).alias("stripped")
    )
