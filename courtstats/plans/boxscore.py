"""Stored game pages to the typed box score.

Everything from HTML to player rows happens inside the page's own row, so no
shuffle is needed: groups, rows and cells become nested arrays, sides and rows
are exploded once, and statistics are picked by position.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtstats import fixed
from courtstats.functions.html import (
    INNER,
    OUTER,
    attribute_values,
    child_fragments,
    element_fragments,
    element_texts,
    nested_texts,
    opening_tag,
    part_before,
    parts_after,
    short_cells,
    text_of,
    texts_of_short,
    visible_html,
)
from courtstats.functions.text import blank_to_zero, first_match, match_groups, strip_text
from courtstats.functions.values import (
    clock_to_seconds,
    parse_date,
    percent_to_ratio,
    plus_minus,
    to_number,
)
from courtstats.operators.reshape import home_away_roles


#: The elements that hold the statistics.
STAT_ELEMENTS = "div", fixed.GROUP_CLASS, fixed.ROW_CLASS, fixed.CELL_CLASS


def stat_groups(html: Column) -> Column:
    """Groups of rows of cell texts; rows without cells are left out."""
    return with_cells(nested_texts(html, *STAT_ELEMENTS))


def with_cells(groups: Column) -> Column:
    """Groups without the rows that have no cells."""
    return F.transform(groups, lambda g: F.filter(g, lambda cells: F.size(cells) > 0))


def stat_headings(html: Column) -> Column:
    """Heading texts of every group."""
    return F.transform(
        parts_after(html, opening_tag("div", fixed.GROUP_CLASS)),
        lambda g: F.transform(
            element_fragments(g, "div", fixed.HEADING_CLASS), text_of
        ),
    )


def player_names(html: Column) -> Column:
    """Names in the player links of a page, home side first."""
    return F.transform(
        attribute_values(html, "a", "href", fixed.PLAYER_LINK_CLASS),
        lambda h: first_match(h, f"^(?:{fixed.PLAYER_LINK})", 1),
    )


def name_rows(html: Column, group: str = opening_tag("div", fixed.GROUP_CLASS)) -> Column:
    """Per side, the bold text of every row in the name container.

    Children are counted only up to the next group of statistics: name rows
    hold no group, and the rest of the page need not be taken apart. In a page with
    short cells ``group`` is the mark ``OUTER``.
    """
    containers = parts_after(html, opening_tag("div", fixed.NAMES_CLASS))

    def bold_text(row: Column) -> Column:
        return strip_text(text_of(F.get(element_fragments(row, "b"), F.lit(0))))

    return F.transform(
        containers,
        lambda c: F.transform(
            after_leading_rows(child_fragments(part_before(c, group))),
            lambda r: bold_text(r),
        ),
    )


def after_leading_rows(rows: Column, leading: int = fixed.LEADING_NAME_ROWS) -> Column:
    return F.filter(rows, lambda row, i: i >= leading)


def has_team_row(rows: Column) -> Column:
    """True when the last row but one is the extra team row."""
    return F.coalesce(
        F.get(rows, F.size(rows) - 2) == fixed.TEAM_ROW, F.lit(False)
    )


def player_count(rows: Column) -> Column:
    """Rows of a side that are players: all but the one or two closing rows."""
    closing = F.when(has_team_row(rows), 2).otherwise(1)
    return F.greatest(F.size(rows) - closing, F.lit(0))


def row_labels(players: Column, with_team: Column) -> Column:
    """Names of a side's rows: its players, then the closing rows."""
    return F.when(
        with_team,
        F.concat(players, F.array(F.lit(fixed.TEAM_ROW), F.lit(fixed.TOTAL_ROW))),
    ).otherwise(F.concat(players, F.array(F.lit(fixed.TOTAL_ROW))))


def head_of(items: Column, n: Column) -> Column:
    return F.slice(items, F.lit(1), n)


def tail_of(items: Column, n: Column) -> Column:
    return F.filter(items, lambda item, i: i >= n)


def game_info(pages: DataFrame, strict: bool = True) -> DataFrame:
    """One record per page: teams, round, date and time of the game."""
    texts = pages.select(
        "page_id",
        element_texts(visible_html(F.col("html")), "h1", fixed.CLUB_CLASS).alias("clubs"),
        element_texts(visible_html(F.col("html")), "li", fixed.INFO_CLASS).alias("info"),
    )
    return texts.select(
        "page_id",
        F.get("clubs", F.lit(0)).alias("home_team"),
        F.get("clubs", F.lit(1)).alias("away_team"),
        *_info_columns(F.col("info"), strict),
    )


def _info_columns(info: Column, strict: bool):
    return [
        first_match(F.get(info, F.lit(0)), fixed.ROUND_NUMBER).alias("Round"),
        parse_date(F.get(info, F.lit(1)), strict).alias("Date"),
        F.get(info, F.lit(3)).alias("GameTime"),
    ]


def page_sides(pages: DataFrame) -> DataFrame:
    """Two rows per page with statistics: labels, groups and the game record.

    ``problem`` is null for a side whose groups fit together; nothing raises here.
    """
    # Pages that never name the class have no group and are not taken apart. The
    # text is cleaned once, and its cells are cut short once, for the five extractions.
    clean = pages.where(F.contains("html", F.lit(fixed.GROUP_CLASS))).select(
        "page_id", "Season", visible_html(F.col("html")).alias("html")
    )
    short = clean.withColumn("short", short_cells(F.col("html"), *STAT_ELEMENTS))
    parsed = short.select(
        "page_id",
        "Season",
        texts_around_cells("h1", fixed.CLUB_CLASS).alias("clubs"),
        texts_around_cells("li", fixed.INFO_CLASS).alias("info"),
        player_names(F.col("short")).alias("players"),
        with_cells(texts_of_short(F.col("short"), STAT_ELEMENTS[0])).alias("groups"),
        name_rows(F.col("short"), OUTER).alias("names"),
    )

    home_rows, away_rows = F.get("names", F.lit(0)), F.get("names", F.lit(1))
    n_home = player_count(home_rows)
    players, groups = F.col("players"), F.col("groups")
    n_groups = F.lit(fixed.GROUPS_PER_SIDE)
    roles = home_away_roles(
        F.get("clubs", F.lit(0)),
        F.get("clubs", F.lit(1)),
        n_groups=(F.size(groups), F.size(groups)),
        groups=(head_of(groups, n_groups), tail_of(groups, n_groups)),
        labels=(
            row_labels(head_of(players, n_home), has_team_row(home_rows)),
            row_labels(tail_of(players, n_home), has_team_row(away_rows)),
        ),
    )
    sides = parsed.select(
        "page_id", "Season", *_info_columns(F.col("info"), strict=False), F.inline(roles)
    )
    return (
        sides.where(F.col("n_groups") > 0)
        .drop("n_groups")
        .withColumn("problem", _side_problem())
    )


def texts_around_cells(tag: str, css_class: str) -> Column:
    """Texts of elements from the page with short cells; of the page itself where they hold cells."""
    texts = F.transform(
        F.array(element_texts(F.col("short"), tag, css_class)),
        lambda found: F.when(
            F.exists(found, lambda text: F.contains(text, F.lit(INNER))),
            element_texts(F.col("html"), tag, css_class),
        ).otherwise(found),
    )
    return F.get(texts, F.lit(0))


def _side_problem() -> Column:
    groups, labels = F.col("groups"), F.col("labels")
    n_rows = F.size(F.get(groups, F.lit(0)))
    row_width = F.aggregate(
        groups,
        F.lit(0),
        lambda n, g: n + F.coalesce(F.size(F.get(g, F.lit(0))), F.lit(0)),
    )
    return (
        F.when(F.col("Season").isNull(), "the link names no season")
        .when(F.col("Team").isNull() | F.col("Opponent").isNull(), "a club name is missing")
        .when(F.col("Round").isNull(), "the round is missing")
        .when(F.col("Date").isNull(), "the date is missing or cannot be read")
        .when(labels.isNull(), "the name rows are missing")
        .when(F.exists(groups, lambda g: F.size(g) != n_rows), "groups differ in rows")
        .when(F.size(labels) != n_rows, "names and rows differ in number")
        .when(
            (row_width != len(fixed.PAGE_STATS))
            | F.exists(
                groups,
                lambda g: F.exists(g, lambda r: F.size(r) != F.size(F.get(g, F.lit(0)))),
            ),
            "rows do not hold all statistics",
        )
        .when(
            F.exists(groups, lambda g: F.exists(g, lambda r: F.exists(r, lambda c: c.isNull()))),
            "a cell does not end",
        )
    )


def rejected_sides(pages: DataFrame) -> DataFrame:
    """Sides that cannot be read, with the reason."""
    return rejects(page_sides(pages)).drop("Season")


def rejects(sides: DataFrame) -> DataFrame:
    """The sides with a problem; give stored sides to read the pages only once."""
    return (
        sides.where(F.col("problem").isNotNull())
        .select("page_id", "Home", "problem", "Season")
    )


def bad_values(sides: DataFrame) -> DataFrame:
    """Texts of readable sides that are no value of their statistic.

    These are null in the typed rows when reading is not strict.
    """
    rows = side_rows(sides, strict=False)
    stats = [c for c in fixed.PAGE_STATS if c in fixed.BOXSCORE_COLUMNS]
    problems = F.filter(
        F.array(
            *[
                F.when(
                    stat_is_bad(c),
                    F.struct(F.lit(c).alias("stat"), F.col(f"`{c}`").alias("value")),
                )
                for c in stats
            ]
        ),
        lambda found: found.isNotNull(),
    )
    return rows.where(F.col("Player") != fixed.TEAM_ROW).select(
        "page_id", "Home", "Player", F.inline(problems), "Season"
    )


def stat_is_bad(stat: str) -> Column:
    """True where a statistic has a text that its type cannot take."""
    text = F.col(f"`{stat}`")
    if stat.endswith("_Percentage"):
        text = first_match(text, fixed.PERCENT, 1)
    elif stat == "PlusMinus":
        text = blank_to_zero(text)
    return text.isNotNull() & stat_value(stat, strict=False).isNull()


def page_rows(pages: DataFrame, strict: bool = True) -> DataFrame:
    """One text row per page, side and label, one column per statistic.

    Strict raises on a side that cannot be read; otherwise it is left out and
    listed by ``rejected_sides``.
    """
    return side_rows(page_sides(pages), strict)


def side_rows(sides: DataFrame, strict: bool = True) -> DataFrame:
    """The rows of ``page_rows`` from sides that are read already."""
    groups = F.col("groups")
    cells = F.transform(
        F.sequence(F.lit(0), F.size("labels") - 1),
        lambda r: F.struct(
            F.get("labels", r).alias("Player"),
            F.flatten(F.transform(groups, lambda g: F.get(g, r))).alias("cells"),
        ),
    )
    if strict:
        message = F.concat_ws(" ", F.lit("page"), F.col("page_id"), F.col("problem"))
        cells = F.when(F.col("problem").isNull(), cells).otherwise(
            F.raise_error(message).cast(
                "array<struct<Player:string,cells:array<string>>>"
            )
        )
    else:
        sides = sides.where(F.col("problem").isNull())
    game = ["Season", "Team", "Opponent", "Home", "Date", "Round", "GameTime"]
    return sides.select("page_id", *game, F.inline(cells)).select(
        "page_id",
        "Player",
        *[
            F.get("cells", F.lit(i)).alias(stat)
            for i, stat in enumerate(fixed.PAGE_STATS)
        ],
        *game,
    )


def stat_value(stat: str, strict: bool = True) -> Column:
    """The typed value of a statistic that is one number."""
    if stat.endswith("_Percentage"):
        return percent_to_ratio(F.col(f"`{stat}`"), strict)
    if stat == "PlusMinus":
        return plus_minus(F.col(stat), strict)
    return to_number(F.col(f"`{stat}`"), "smallint", strict)


def typed_boxscore(rows: DataFrame, strict: bool = True) -> DataFrame:
    """The thirty columns of the box score and the season.

    Makes, attempts and the round stay text here, as in the raw table.
    """
    pairs = {
        "2P_Made/Attempted": ["TwoPMakes", "TwoPAttempts"],
        "3P_Made/Attempted": ["ThreePMakes", "ThreePAttempts"],
        "FTP_Made/Attempted": ["FTMakes", "FTAttempts"],
    }
    columns = {"Seconds": clock_to_seconds(F.col("Minutes"))}
    for source, (makes, attempts) in pairs.items():
        groups = match_groups(F.col(f"`{source}`"), fixed.MADE_ATTEMPTED, [makes, attempts])
        columns[makes], columns[attempts] = groups[makes], groups[attempts]
    for stat in fixed.PAGE_STATS:
        if stat in fixed.BOXSCORE_COLUMNS:
            columns[stat] = stat_value(stat, strict)
    return rows.where(F.col("Player") != fixed.TEAM_ROW).select(
        *[
            columns.get(c, F.col(f"`{c}`")).alias(c)
            for c in [*fixed.BOXSCORE_COLUMNS, "Season"]
        ]
    )


def boxscore(pages: DataFrame, strict: bool = True) -> DataFrame:
    """Typed box score of all pages; pages without statistics give no rows."""
    return typed_boxscore(page_rows(pages, strict), strict)
