"""Running counts, sums and means."""

from pyspark.sql import functions as F

from courtstats.catalog.registry import query
from courtstats.catalog.tables import (
    FACT_DUCK,
    FACT_MEASURES,
    TEAM_ROUNDS_DUCK,
    fact,
    running_duck,
    table,
    team_rounds,
)
from courtstats.operators.running import HotKeySplit, running_means, running_totals

EVENT_ORDER = ["ts", "event_id"]


@query(
    "player_running_avg",
    """select event_id, user_id, count(user_id) over w as game_number,
              (sum(value::decimal(18,2)) over w)::double
                / (count(user_id) over w) as avg_value
       from events window w as (partition by user_id order by ts, event_id
         rows between unbounded preceding and current row)""",
)
def player_running_avg(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.col("value").cast("decimal(18,2)").alias("value")
    )
    means = running_means(
        events, ["user_id"], EVENT_ORDER, {"avg_value": "value"}, "user_id"
    )
    return means.select("event_id", "user_id", "game_number", "avg_value")


@query(
    "cum_count",
    """select event_id,
              count(user_id) over (partition by user_id order by ts, event_id
                rows between unbounded preceding and current row) as user_number,
              count(event_type) over (partition by event_type order by ts, event_id
                rows between unbounded preceding and current row) as type_number
       from events""",
)
def cum_count(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts"
    )
    by_user = running_totals(
        events, ["user_id"], EVENT_ORDER, {}, "user_id", "user_number"
    )
    by_type = running_totals(
        by_user, ["event_type"], EVENT_ORDER, {}, "event_type", "type_number"
    )
    return by_type.select("event_id", "user_number", "type_number")


@query(
    "cum_sum",
    """select event_id, user_id,
              case when event_type <> 'error' then
                (sum(case when event_type <> 'error' then value::decimal(18,2) end)
                  over (partition by user_id order by ts, event_id
                  rows between unbounded preceding and current row))::double
              end as running_value
       from events""",
)
def cum_sum(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.when(
            F.col("event_type") != "error", F.col("value").cast("decimal(18,2)")
        ).alias("value"),
    )
    totals = running_totals(
        events, ["user_id"], EVENT_ORDER, {"running_value": "value"}, "user_id"
    )
    return totals.select(
        "event_id", "user_id", F.col("running_value").cast("double").alias("running_value")
    )


@query(
    "team_running_avg",
    f"""with {FACT_DUCK}, {TEAM_ROUNDS_DUCK}
        select season, team, round, game_number,
               {', '.join('avg_' + m for m in FACT_MEASURES)}
        from ({running_duck('team_rounds', ['season', 'team'], ['round'], FACT_MEASURES, 'team')})""",
)
def team_running_avg(spark, sf_dir):
    totals = team_rounds(fact(spark, sf_dir))
    means = running_means(
        totals,
        ["season", "team"],
        ["round"],
        {f"avg_{m}": m for m in FACT_MEASURES},
        "team",
        split=None,  # at most one row a month per key
    )
    return means.select(
        "season", "team", "round", "game_number", *[f"avg_{m}" for m in FACT_MEASURES]
    )


@query(
    "hot_key_running",
    """select event_id, event_type, count(*) over w as type_number,
              (sum(value::decimal(18,2)) over w)::double as type_total
       from events window w as (partition by event_type order by ts, event_id
         rows between unbounded preceding and current row)""",
)
def hot_key_running(spark, sf_dir):
    """Five keys hold all rows, so each is cut into blocks."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts", F.col("value").cast("decimal(18,2)").alias("value")
    )
    totals = running_totals(
        events,
        ["event_type"],
        EVENT_ORDER,
        {"type_total": "value"},
        "event_id",
        "type_number",
        HotKeySplit(min_rows=100, shares=16),
    )
    return totals.select(
        "event_id", "event_type", "type_number", F.col("type_total").cast("double").alias("type_total")
    )
