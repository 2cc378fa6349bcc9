"""Box scores and features from game pages, and the season sheet."""

from pyspark.sql import functions as F

from courtstats import fixed
from courtstats.catalog.games import (
    BOX_DUCK,
    GAMES_DUCK,
    game_pages,
    number_sql,
    season_sheets,
    sheet_duck,
    slug_sql,
    team_sql,
)
from courtstats.catalog.registry import query
from courtstats.functions.html import OUTER, short_cells, visible_html
from courtstats.operators.joins import unmatched_keys
from courtstats.plans.boxscore import (
    STAT_ELEMENTS,
    bad_values,
    boxscore,
    game_info,
    has_team_row,
    head_of,
    name_rows,
    page_rows,
    page_sides,
    player_count,
    player_names,
    rejected_sides,
    row_labels,
    stat_headings,
    tail_of,
    typed_boxscore,
)
from courtstats.plans.features import (
    player_running_averages,
    prepare_sheet,
    team_running_averages,
)
from courtstats.plans.links import collect_links, player_links
from courtstats.plans.season import features_from_pages
from courtstats.sources.shared import stage
from courtstats.sources.tables import with_page_season

PERCENTS = ["2P_Percentage", "3P_Percentage", "FTP_Percentage"]


def comparable(df):
    """Decimals and nullable numbers as doubles, dates as text, others as bigint."""
    columns = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind == "decimal" or f.name == "Seconds":
            c = c.cast("double")
        elif kind == "date":
            # Spark puts a plus before years of more than four digits.
            c = F.ltrim(c.cast("string"), F.lit("+"))
        elif kind in ("short", "integer"):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _box_duck_columns(text_numbers: bool):
    out = []
    for c in fixed.BOXSCORE_COLUMNS:
        if c in PERCENTS:
            out.append(f'"{c}"::double / 1000 as "{c}"')
        elif c == "Seconds":
            out.append('"Seconds"::double as "Seconds"')
        elif c == "Date":
            out.append('"Date"::varchar as "Date"')
        elif c in fixed.TEXT_NUMBERS and text_numbers:
            out.append(f'"{c}"::varchar as "{c}"')
        elif c in ("Player", "Team", "Opponent", "GameTime", "Home"):
            out.append(f'"{c}"')
        else:
            out.append(f'"{c}"::bigint as "{c}"')
    return ", ".join(out)


@query(
    "boxscore_from_pages",
    f'with {BOX_DUCK} select {_box_duck_columns(True)}, "Season" from box',
)
def boxscore_from_pages(spark, sf_dir):
    return comparable(boxscore(game_pages(spark, sf_dir)))


@query(
    "page_record",
    f"""with games as ({GAMES_DUCK})
        select g as page_id, {team_sql('home')} as home_team, {team_sql('away')} as away_team,
               round_number::varchar as "Round", game_date::varchar as "Date",
               game_time as "GameTime" from games""",
)
def page_record(spark, sf_dir):
    return comparable(game_info(game_pages(spark, sf_dir)))


@query(
    "nonempty_pages",
    f"""with games as ({GAMES_DUCK})
        select g as page_id, true as "Home",
               n_home + 1 + home_extra::int as n_rows from games where not no_stats
        union all
        select g, false, n_away + 1 + away_extra::int from games where not no_stats""",
)
def nonempty_pages(spark, sf_dir):
    sides = page_sides(game_pages(spark, sf_dir))
    return sides.select(
        "page_id", "Home", F.size("labels").cast("bigint").alias("n_rows")
    )


@query(
    "stat_headings",
    f"""with games as ({GAMES_DUCK})
        select g as page_id, k as group_number,
               case k % 9 {' '.join(
                   f"when {i} then '{h}'" for i, h in enumerate(
                       [','.join(fixed.PAGE_STATS[a:b]) for a, b in zip(
                           [0, 1, 2, 4, 6, 8, 11, 14, 16], [1, 2, 4, 6, 8, 11, 14, 16, 20])]
                   ))} end as headings
        from (select *, unnest(range(18::bigint)) as k from games where not no_stats) a""",
)
def headings(spark, sf_dir):
    pages = game_pages(spark, sf_dir)
    return pages.select(
        "page_id",
        F.posexplode(stat_headings(visible_html(F.col("html")))).alias("k", "h"),
    ).select(
        "page_id",
        F.col("k").cast("bigint").alias("group_number"),
        F.array_join("h", ",").alias("headings"),
    )


def _labels_duck(team, n, extra):
    names = f"list_transform(range({n}::bigint), lambda i: {slug_sql(team, 'i')})"
    return (
        f"array_to_string(list_concat({names},"
        f" case when {extra} then ['Team', 'Total'] else ['Total'] end), ',')"
    )


@query(
    "marker_rows",
    f"""with games as ({GAMES_DUCK})
        select g as page_id, home_extra as home_team_row, away_extra as away_team_row,
               n_home as home_players, n_away as away_players,
               {_labels_duck('home', 'n_home', 'home_extra')} as home_labels,
               {_labels_duck('away', 'n_away', 'away_extra')} as away_labels
        from games where not no_stats""",
)
def marker_rows(spark, sf_dir):
    # Every step is a column of its own, and what two sides need comes as an array of
    # one: a filter would be worked out below the columns it reads, and again for them.
    pages = game_pages(spark, sf_dir).select("page_id", visible_html(F.col("html")).alias("html"))
    short = pages.select("page_id", short_cells(F.col("html"), *STAT_ELEMENTS).alias("html"))
    found = short.select(
        "page_id",
        F.array(
            F.struct(
                name_rows(F.col("html"), OUTER).alias("rows"),
                player_names(F.col("html")).alias("players"),
            )
        ).alias("found"),
    )
    rows = found.select(
        "page_id", F.inline(F.filter("found", lambda f: F.size(f["rows"]) == 2))
    )
    home, away = F.col("rows")[0], F.col("rows")[1]
    return rows.select(
        "page_id",
        has_team_row(home).alias("home_team_row"),
        has_team_row(away).alias("away_team_row"),
        player_count(home).cast("bigint").alias("home_players"),
        player_count(away).cast("bigint").alias("away_players"),
        F.array_join(
            row_labels(head_of(F.col("players"), player_count(home)), has_team_row(home)), ","
        ).alias("home_labels"),
        F.array_join(
            row_labels(tail_of(F.col("players"), player_count(home)), has_team_row(away)), ","
        ).alias("away_labels"),
    )


@query(
    "player_links",
    f"""with games as ({GAMES_DUCK}), sides as (
          select g, home as k, round_number, 0 as start,
                 unnest(range(n_home::bigint)) as i from games where not no_stats
          union all
          select g, away, round_number, n_home,
                 unnest(range(n_away::bigint)) as i from games where not no_stats)
        select g as page_id, start + i as position,
               concat('/euroleague/players/', names, '/00', k * 8 + i, '/') as links, names
        from (select *, {slug_sql('k', 'i')} as names from sides) a""",
)
def player_link_table(spark, sf_dir):
    links = player_links(game_pages(spark, sf_dir))
    return links.withColumn("position", F.col("position").cast("bigint"))


@query(
    "typed_page_rows",
    f"""with {BOX_DUCK} select "Season", count(*) as n_rows, count("Seconds") as n_played,
          sum("Points")::bigint as points, sum("TwoPMakes")::bigint as two_point_makes,
          sum("PlusMinus")::bigint as plus_minus from box group by 1""",
)
def typed_page_rows(spark, sf_dir):
    rows = typed_boxscore(page_rows(game_pages(spark, sf_dir), strict=False), strict=False)
    return rows.groupBy("Season").agg(
        F.count("*").alias("n_rows"),
        F.count("Seconds").alias("n_played"),
        F.sum("Points").alias("points"),
        F.sum(F.col("TwoPMakes").cast("int")).alias("two_point_makes"),
        F.sum("PlusMinus").alias("plus_minus"),
    )


# What is wrong with some pages: remainder of the page number, change, problem and
# the sides that have it.
_CELL = f'{fixed.CELL_CLASS}">'
FAULTS = [
    (3, "url", ("/E[0-9]+/", "/E/"), "the link names no season", "true, false"),
    (5, "html", ("<div>Players</div>", "<div></div><div></div>"),
     "names and rows differ in number", "true, false"),
    (7, "html", (fixed.CLUB_CLASS, "club"), "a club name is missing", "true, false"),
    (9, "html", ("[0-9]+ [A-Z][a-z]{2} [0-9]{4}</li>", "soon</li>"),
     "the date is missing or cannot be read", "true, false"),
    (11, "html", (f'(?s)^(.*?{_CELL}[^<]*)</div>(?=<div class="{_CELL})', "$1"), "a cell does not end", "true"),
    (12, "html", (f"(?s)^(.*){_CELL}", '$1x">'), "rows do not hold all statistics", "false"),
]
# Before the first cell of the third group, the second one that is shown: points.
_POINTS = f'(?s)^((?:.*?{fixed.GROUP_CLASS}">){{3}}.*?{_CELL})'


def faulty_pages(spark, sf_dir):
    pages = game_pages(spark, sf_dir).drop("Season")
    # A page has one fault at most, so each column is changed in one step.
    for column in ("url", "html"):
        changed = F.when(F.lit(False), F.col(column))
        for rest, where, (pattern, new), _, _ in FAULTS:
            if where == column:
                changed = changed.when(F.col("page_id") % 13 == rest, F.regexp_replace(column, pattern, new))
        pages = pages.withColumn(column, changed.otherwise(F.col(column)))
    return with_page_season(pages)


@query(
    "rejected_sides",
    f"with games as ({GAMES_DUCK}) "
    + " union all ".join(
        f"""select g as page_id, unnest([{sides}]) as "Home", '{problem}' as problem
            from games where g % 13 = {rest} and not no_stats"""
        for rest, _, _, problem, sides in FAULTS
    ),
)
def rejected(spark, sf_dir):
    """Sides that cannot be read, of pages with faults of every kind."""
    return rejected_sides(faulty_pages(spark, sf_dir))


@query(
    "bad_values",
    f"""with games as ({GAMES_DUCK})
        select g as page_id, true as "Home", {slug_sql('home', '0')} as "Player", 'Points' as stat,
               concat('x', {number_sql(1, 0, '0')}) as value, concat(year - 2000, '_', year - 1999) as "Season"
        from games where g % 13 = 4 and not no_stats""",
)
def values_that_are_none(spark, sf_dir):
    """Points that are no number on some pages: listed, and null when typed."""
    pages = game_pages(spark, sf_dir)
    broken = F.regexp_replace("html", _POINTS, "$1x")
    pages = pages.withColumn(
        "html", F.when(F.col("page_id") % 13 == 4, broken).otherwise(F.col("html"))
    )
    return bad_values(page_sides(pages))


@query(
    "unmatched_teams",
    f"""with {BOX_DUCK}, teams as (select range as k from range(24))
        select distinct "Season", "Team" from box join teams on "Team" = {team_sql('k')}
        where k % 5 = 2""",
)
def unmatched_teams(spark, sf_dir):
    """Teams of the games that the season sheets do not name."""
    totals = boxscore(game_pages(spark, sf_dir)).where(F.col("Player") == fixed.TOTAL_ROW)
    sheets = season_sheets(spark, sf_dir).where("cast(split(TEAM, ' ')[size(split(TEAM, ' ')) - 1] as int) % 5 <> 2")
    return unmatched_keys(totals, sheets, ["Season", "Team"], ["Season", fixed.SHEET_KEY])


@query(
    "prepare_dim",
    f"""with games as ({GAMES_DUCK}), {sheet_duck()}
        select team as "TEAM", {', '.join(f'"{c}"' for c in fixed.SHEET_STATS)},
               season as "Season" from sheet""",
)
def prepare_dim(spark, sf_dir):
    return prepare_sheet(season_sheets(spark, sf_dir))


def _running(source, keys, order, measures, count_of='"Player"'):
    def mean(m):
        value = f'(sum("{m}") over w)::double'
        if m in PERCENTS:
            value += " / 1000"
        return (
            f'case when "{m}" is not null then {value} / (count({count_of}) over w) end'
            f' as "{fixed.average_name(m)}"'
        )

    return (
        f"select *, count({count_of}) over w as game_number,"
        f" {', '.join(mean(m) for m in measures)} from {source}"
        f" window w as (partition by {keys} order by {order}"
        " rows between unbounded preceding and current row)"
    )


SEASON_DUCK = f"""with {BOX_DUCK}, {sheet_duck()},
 teams as ({_running(
     "(select * from box where \"Player\" = 'Total') a", '"Season", "Team"', '"Date", "Round"',
     fixed.TEAM_MEASURES)}),
 players as (select *, greatest("Round" - 1, 1) as merge_round from ({_running(
     "(select * from box where \"Player\" <> 'Total') a", '"Season", "Player"',
     '"Date", "Round", "GameTime", "Team", "Opponent"', fixed.PLAYER_MEASURES)}) b)"""
TEAM_AVERAGES = [fixed.average_name(m) for m in fixed.TEAM_MEASURES]
PLAYER_AVERAGES = [fixed.average_name(m) for m in fixed.PLAYER_MEASURES]


def _player_duck(alias):
    typed = _box_duck_columns(False)
    for c in fixed.BOXSCORE_COLUMNS:
        typed = typed.replace(f'"{c}"::', f'{alias}."{c}"::')
    named = [
        part if part.startswith(f"{alias}.") else f"{alias}.{part}"
        for part in typed.split(", ")
    ]
    averages = [f'{alias}."{a}"' for a in PLAYER_AVERAGES]
    return ", ".join([*named, f"{alias}.game_number", *averages])


@query(
    "team_running_averages",
    f"""{SEASON_DUCK} select {', '.join(f'"{a}"' for a in TEAM_AVERAGES)}, game_number,
        "Team", "Player", "Round"::bigint as "Round", "Season" from teams""",
)
def team_averages(spark, sf_dir):
    raw = stage(boxscore(game_pages(spark, sf_dir)), "raw-stats")
    return comparable(team_running_averages(raw))


@query(
    "player_running_averages",
    f"""{SEASON_DUCK} select {_player_duck('p')}, p."Season" from players p""",
)
def player_averages(spark, sf_dir):
    raw = stage(boxscore(game_pages(spark, sf_dir)), "raw-stats")
    return comparable(player_running_averages(raw))


def _suffixed(alias, suffix):
    return ", ".join(f'{alias}."{a}" as "{a}{suffix}"' for a in TEAM_AVERAGES)


def _sheet_columns(alias, suffix):
    return ", ".join(f'{alias}."{c}" as "{c}{suffix}"' for c in fixed.SHEET_STATS)


@query(
    "season_features",
    f"""{SEASON_DUCK}
        select {_player_duck('p')}, p.merge_round::bigint as merge_round,
               {_suffixed('o', '_own_team')}, {_suffixed('x', '_opponent')},
               {_sheet_columns('d1', '')}, {_sheet_columns('d2', '_opponent')}, p."Season"
        from players p
        join teams o on o."Season" = p."Season" and o."Team" = p."Team"
             and o."Round" = p.merge_round and o."Round" <> 34
        join teams x on x."Season" = p."Season" and x."Team" = p."Opponent"
             and x."Round" = p.merge_round and x."Round" <> 34
        join sheet d1 on d1.season = p."Season" and d1.team = p."Team"
        join sheet d2 on d2.season = p."Season" and d2.team = p."Opponent" """,
)
def season_features(spark, sf_dir):
    features = features_from_pages(
        game_pages(spark, sf_dir), season_sheets(spark, sf_dir)
    )
    return comparable(features)


@query(
    "collect_game_links",
    f"""with games as ({GAMES_DUCK})
        select concat('/euroleague/game-center/', year, '-', lpad(((year + 1) % 100)::varchar, 2, '0'),
                      '/a-b/E', year, '/', (round_number - 1) * 12 + slot + 1, '/') as href,
               min(g) as page_id, 0::bigint as position
        from games group by 1""",
)
def collect_game_links(spark, sf_dir):
    """Listing pages with every game's link twice and one link of another kind."""
    pages = game_pages(spark, sf_dir)
    link = """concat('<a href="', url, '">game</a>')"""
    listing = pages.select(
        "page_id",
        F.expr(
            f"""concat({link}, '<a href="/news', url, '">news</a>', {link})"""
        ).alias("html"),
    )
    links = collect_links(listing)
    return links.withColumn("position", F.col("position").cast("bigint"))
