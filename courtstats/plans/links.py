"""Links on stored pages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.fixed import GAME_LINK, PLAYER_LINK, PLAYER_LINK_CLASS
from courtstats.functions.html import attribute_values, visible_html
from courtstats.functions.text import first_match, starts_with_pattern
from courtstats.operators.reshape import ordered_distinct


def season_game_link(start_year: int) -> str:
    """The game link pattern of one season."""
    label = f"{start_year}-{(start_year + 1) % 100:02d}"
    return rf"/euroleague/game-center/{label}/[\w-]+/E{start_year}/[\d]{{1,3}}/"


def page_links(pages: DataFrame, css_class: str | None = None) -> DataFrame:
    """All link targets with page and position."""
    hrefs = attribute_values(visible_html(F.col("html")), "a", "href", css_class)
    return pages.select("page_id", F.posexplode(hrefs).alias("position", "href"))


def collect_links(pages: DataFrame, pattern: str = GAME_LINK) -> DataFrame:
    """Distinct links that start with the pattern, with their first occurrence."""
    links = page_links(pages).where(starts_with_pattern(F.col("href"), pattern))
    return ordered_distinct(links, "href", ["page_id", "position"])


def player_links(
    pages: DataFrame,
    css_class: str | None = PLAYER_LINK_CLASS,
    pattern: str = PLAYER_LINK,
) -> DataFrame:
    """Player links and the names in them, in page order."""
    links = page_links(pages, css_class)
    return links.select(
        "page_id",
        "position",
        F.col("href").alias("links"),
        first_match(F.col("href"), f"^(?:{pattern})", 1).alias("names"),
    )
