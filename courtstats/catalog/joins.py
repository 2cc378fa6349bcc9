"""Joins to the previous round, joins to season statistics, and the flagship."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.catalog.registry import query
from courtstats.catalog.tables import (
    FACT_DUCK,
    FACT_MEASURES,
    FACT_ORDER,
    LAST_MONTH,
    TEAM_ROUNDS_DUCK,
    fact,
    running_duck,
    table,
    team_rounds,
)
from courtstats.functions.text import concat_key
from courtstats.functions.values import percent_number_to_ratio, previous_round
from courtstats.operators.joins import join_suffix
from courtstats.operators.running import running_means
from courtstats.sources.shared import stage

AVERAGES = [f"avg_{m}" for m in FACT_MEASURES]
ROW_KEYS = [
    "season", "round", "player", "team", "opponent",
    "l_orderkey", "l_linenumber", "l_partkey",
]


def player_rows(rows: DataFrame) -> DataFrame:
    means = running_means(
        rows,
        ["season", "player"],
        FACT_ORDER,
        {f"avg_{m}": m for m in FACT_MEASURES},
        "player",
    )
    return means.select(*ROW_KEYS, "game_number", *AVERAGES)


def team_rows(rows: DataFrame) -> DataFrame:
    """Team averages up to the last but one month, written once.

    A team has at most one row a month here, so no key can be hot.
    """
    means = running_means(
        team_rounds(rows),
        ["season", "team"],
        ["round"],
        {f"avg_{m}": m for m in FACT_MEASURES},
        "team",
        split=None,
    )
    kept = means.where(F.col("round") != LAST_MONTH)
    return stage(kept.select("season", "team", "round", *AVERAGES), "team-rounds")


def with_merge_round(rows: DataFrame) -> DataFrame:
    return rows.withColumn("merge_round", previous_round(F.col("round")))


def lag_join(rows: DataFrame, teams: DataFrame, role: str, suffix: str) -> DataFrame:
    return join_suffix(
        rows,
        teams,
        ["season", role, "merge_round"],
        ["season", "team", "round"],
        suffix,
    )


PLAYERS_DUCK = (
    "players as (select *, greatest(round - 1, 1) as merge_round from ("
    + running_duck("fact", ["season", "player"], FACT_ORDER, FACT_MEASURES, "player")
    + "))"
)
TEAMS_DUCK = (
    "teams as (select * from ("
    + running_duck("team_rounds", ["season", "team"], ["round"], FACT_MEASURES, "team")
    + f") where round <> {LAST_MONTH})"
)
LAG_DUCK = f"with {FACT_DUCK}, {TEAM_ROUNDS_DUCK}, {PLAYERS_DUCK}, {TEAMS_DUCK}"
KEYS_DUCK = ", ".join(f"p.{k}" for k in ROW_KEYS)
OWN_DUCK = (
    "join teams o on p.season = o.season and p.team = o.team and p.merge_round = o.round"
)
OTHER_DUCK = (
    "join teams x on p.season = x.season and p.opponent = x.team"
    " and p.merge_round = x.round"
)


def _averages(alias, suffix):
    return ", ".join(f"{alias}.{a} as {a}{suffix}" for a in AVERAGES)


FACT_KEYS_DUCK = f"""with {FACT_DUCK}, {TEAM_ROUNDS_DUCK}, {TEAMS_DUCK},
  players as (select *, greatest(round - 1, 1) as merge_round from fact)"""


@query(
    "lagged_team_join",
    f"""{FACT_KEYS_DUCK}
        select {KEYS_DUCK}, p.merge_round, {_averages('o', '')} from players p {OWN_DUCK}""",
)
def lagged_team_join(spark, sf_dir):
    rows = stage(fact(spark, sf_dir).select(*ROW_KEYS, *FACT_MEASURES), "fact")
    teams = team_rows(rows)
    joined = lag_join(with_merge_round(rows.select(*ROW_KEYS)), teams, "team", "_own_team")
    return joined.withColumn("merge_round", F.col("merge_round").cast("bigint"))


@query(
    "lagged_opponent_join",
    f"""{FACT_KEYS_DUCK}
        select {KEYS_DUCK}, p.merge_round, {_averages('x', '')} from players p {OTHER_DUCK}""",
)
def lagged_opponent_join(spark, sf_dir):
    rows = stage(fact(spark, sf_dir).select(*ROW_KEYS, *FACT_MEASURES), "fact")
    teams = team_rows(rows)
    joined = lag_join(
        with_merge_round(rows.select(*ROW_KEYS)), teams, "opponent", "_opponent"
    )
    return joined.withColumn("merge_round", F.col("merge_round").cast("bigint"))


def lag_features(rows: DataFrame) -> DataFrame:
    """The rows are read by the team and the player branch: written once."""
    rows = stage(rows, "fact")
    teams = team_rows(rows)
    players = with_merge_round(player_rows(rows))
    own = lag_join(players, teams, "team", "_own_team")
    return lag_join(own, teams, "opponent", "_opponent").drop("merge_round")


@query(
    "round_lag_features",
    f"""{LAG_DUCK}
        select {KEYS_DUCK}, p.game_number, {_averages('p', '')},
               {_averages('o', '_own_team')}, {_averages('x', '_opponent')}
        from players p {OWN_DUCK} {OTHER_DUCK}""",
)
def round_lag_features(spark, sf_dir):
    return lag_features(fact(spark, sf_dir))


def nation_statistics(spark, sf_dir) -> DataFrame:
    """Statistics per nation of suppliers; a nation may lack its key."""
    supplier = table(spark, sf_dir, "supplier")
    return (
        supplier.groupBy("s_nationkey")
        .agg(
            F.count("*").alias("PACE"),
            F.sum(F.col("s_acctbal").cast("decimal(18,2)")).alias("balance"),
        )
        .select(
            F.col("s_nationkey").alias("TEAM"),
            "PACE",
            percent_number_to_ratio(F.col("balance").cast("double")).alias("ST%"),
        )
    )


DIM_DUCK = """dim as (select s_nationkey as k, count(*) as pace,
    sum(s_acctbal::decimal(18,2))::double / 100 as st from supplier group by 1)"""


@query(
    "full_features",
    f"""{LAG_DUCK}, {DIM_DUCK}
        select {KEYS_DUCK}, p.game_number, {_averages('p', '')},
               {_averages('o', '_own_team')}, {_averages('x', '_opponent')},
               d1.pace as "PACE", d1.st as "ST%",
               d2.pace as "PACE_opponent", d2.st as "ST%_opponent"
        from players p {OWN_DUCK} {OTHER_DUCK}
        join dim d1 on d1.k = p.team join dim d2 on d2.k = p.opponent""",
)
def full_features(spark, sf_dir):
    rows = lag_features(fact(spark, sf_dir))
    nations = nation_statistics(spark, sf_dir)
    own = join_suffix(rows, nations, ["team"], ["TEAM"], "_own_team")
    return join_suffix(own, nations, ["opponent"], ["TEAM"], "_opponent")


@query(
    "dim_join_own",
    f"""with {DIM_DUCK} select c_custkey, c_nationkey, pace as "PACE", st as "ST%"
        from customer join dim on k = c_nationkey""",
)
def dim_join_own(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = nation_statistics(spark, sf_dir)
    return join_suffix(customer, nations, ["c_nationkey"], ["TEAM"], "_own_team")


@query(
    "dim_join_opponent",
    f"""with {DIM_DUCK}
        select o_orderkey, d1.pace as "PACE", d1.st as "ST%",
               d2.pace as "PACE_opponent", d2.st as "ST%_opponent"
        from (select o_orderkey, c_nationkey as team, o_custkey % 25 as opponent
              from orders join customer on o_custkey = c_custkey) p
        join dim d1 on d1.k = p.team join dim d2 on d2.k = p.opponent""",
)
def dim_join_opponent(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    games = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("c_nationkey").alias("team"),
        (F.col("o_custkey") % 25).alias("opponent"),
    )
    nations = nation_statistics(spark, sf_dir)
    own = join_suffix(games, nations, ["team"], ["TEAM"], "_own_team")
    both = join_suffix(own, nations, ["opponent"], ["TEAM"], "_opponent")
    return both.drop("team", "opponent")


@query(
    "join_suffix",
    """with s as (select s_nationkey as nation, count(*) as suppliers,
                  sum(s_acctbal::decimal(18,2))::double as balance from supplier group by 1)
       select c.c_custkey, c.c_nationkey as nation, c.c_acctbal as balance,
              s.suppliers, s.balance as balance_supplier, n.n_name
       from customer c join s on c.c_nationkey = s.nation
       join nation n on n.n_nationkey = c.c_nationkey""",
)
def join_with_suffix(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )
    supplier = (
        table(spark, sf_dir, "supplier")
        .groupBy(F.col("s_nationkey").alias("nation"))
        .agg(
            F.count("*").alias("suppliers"),
            F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
        )
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    both = join_suffix(customer, supplier, ["nation"], ["nation"], "_supplier")
    return join_suffix(both, nation, ["nation"], ["n_nationkey"], "_nation")


@query(
    "lag_round",
    """select o_orderkey, month(o_orderdate) as round,
              case when month(o_orderdate) - 1 = 0 then 1
                   else month(o_orderdate) - 1 end as merge_round
       from orders""",
)
def lag_round(spark, sf_dir):
    month = F.month("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        month.cast("bigint").alias("round"),
        previous_round(month).cast("bigint").alias("merge_round"),
    )


@query(
    "concat_key",
    """select o_orderkey,
              nullif(o_orderpriority, '5-LOW') || month(o_orderdate)::varchar as team_round
       from orders""",
)
def concat_keys(spark, sf_dir):
    team = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", concat_key(team, F.month("o_orderdate")).alias("team_round")
    )
