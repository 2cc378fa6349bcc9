"""The given tables, and the roles they play in the feature queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtstats.sources.tables import read_table

LAST_MONTH = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


FACT_MEASURES = {
    "points": "l_quantity",
    "gross": "l_extendedprice",
    "discount": "l_discount",
    "tax": "l_tax",
}
# A total order of the rows of a supplier; a test looks for ties.
FACT_ORDER = ["o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as player rows: supplier = player, nations = teams.

    Measures are decimals of eight digits, whose running sums stay in one machine
    word. A value that does not fit raises.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.year("o_orderdate").cast("bigint").alias("season"),
            F.month("o_orderdate").cast("bigint").alias("round"),
            F.col("l_suppkey").alias("player"),
            F.col("s_nationkey").alias("team"),
            F.col("c_nationkey").alias("opponent"),
            "o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
            *[
                F.col(c).cast("decimal(8,2)").alias(m)
                for m, c in FACT_MEASURES.items()
            ],
        )
    )


FACT_DUCK = """fact as (
  select year(o_orderdate) as season, month(o_orderdate) as round,
         l_suppkey as player, s_nationkey as team, c_nationkey as opponent,
         o_orderdate, l_orderkey, l_linenumber, l_partkey, l_shipdate,
         l_quantity::decimal(18,2) as points,
         l_extendedprice::decimal(18,2) as gross,
         l_discount::decimal(18,2) as discount, l_tax::decimal(18,2) as tax
  from lineitem join orders on l_orderkey = o_orderkey
       join customer on o_custkey = c_custkey
       join supplier on l_suppkey = s_suppkey)"""


def team_rounds(rows: DataFrame) -> DataFrame:
    """Totals per team and round: the part the page's total row plays."""
    return rows.groupBy("season", "team", "round").agg(
        *[F.sum(m).alias(m) for m in FACT_MEASURES]
    )


TEAM_ROUNDS_DUCK = (
    "team_rounds as (select season, team, round, "
    + ", ".join(f"sum({m}) as {m}" for m in FACT_MEASURES)
    + " from fact group by all)"
)


def running_duck(source, keys, order, measures, count_of, as_decimal=True):
    """Running count and means of a table in DuckDB SQL."""
    means = ", ".join(
        f"case when {m} is not null then (sum({m}) over w)::double"
        f' / (count({count_of}) over w) end as "avg_{m}"'
        for m in measures
    )
    return (
        f"select *, count({count_of}) over w as game_number, {means} from {source}"
        f" window w as (partition by {', '.join(keys)} order by {', '.join(order)}"
        " rows between unbounded preceding and current row)"
    )
