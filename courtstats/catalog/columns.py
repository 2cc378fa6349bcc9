"""Projection, filters, scalar functions and reshaping on the given tables."""

from pyspark.sql import functions as F

from courtstats.catalog.registry import query
from courtstats.catalog.tables import table
from courtstats.functions.text import blank_to_zero
from courtstats.functions.values import (
    clock_to_seconds,
    parse_date,
    percent_to_ratio,
    season_name,
    season_site_label,
    to_number,
)
from courtstats.operators.reshape import (
    home_away_roles,
    pivot_wide,
    transpose,
    union_all,
    unpivot_long,
)


def money(name):
    return F.col(name).cast("decimal(18,2)")


@query(
    "union_all",
    """select c_custkey as key, c_nationkey as nation, c_acctbal as balance from customer
       union all select s_suppkey, s_nationkey, s_acctbal from supplier""",
)
def union(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_suppkey").alias("key"),
        F.col("s_nationkey").alias("nation"),
    )
    return union_all(customer, supplier)


@query(
    "rename_cols",
    """select s_suppkey as "Player", s_name, s_nationkey as "Team", s_acctbal from supplier""",
)
def rename_cols(spark, sf_dir):
    return table(spark, sf_dir, "supplier").withColumnsRenamed(
        {"s_suppkey": "Player", "s_nationkey": "Team"}
    )


@query(
    "drop_cols",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders",
)
def drop_cols(spark, sf_dir):
    return table(spark, sf_dir, "orders").drop("o_orderdate", "o_orderpriority", "absent")


@query(
    "project_cols",
    """select c_custkey as "TEAM", c_nationkey as "AST/TO", c_acctbal as "OR%",
              c_acctbal / 100 as "OFF RTG" from customer""",
)
def project_cols(spark, sf_dir):
    wide = table(spark, sf_dir, "customer").select(
        "c_name",
        F.col("c_custkey").alias("TEAM"),
        F.col("c_nationkey").alias("AST/TO"),
        F.col("c_acctbal").alias("OR%"),
        (F.col("c_acctbal") / 100).alias("OFF RTG"),
    )
    return wide.select("TEAM", "`AST/TO`", "`OR%`", "`OFF RTG`")


@query(
    "derive_cols",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
              (l_extendedprice::decimal(18,2) * (1 - l_discount::decimal(18,2)))::double as net,
              l_tax * 2 as l_tax, true as "Home", '97_98' as "Season" from lineitem""",
)
def derive_cols(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            "l_extendedprice", "l_discount", "l_tax",
        )
        .withColumns(
            {
                "net": (money("l_extendedprice") * (1 - money("l_discount"))).cast("double"),
                "l_tax": F.col("l_tax") * 2,
                "Home": F.lit(True),
                "Season": F.lit("97_98"),
            }
        )
        .drop("l_extendedprice", "l_discount")
    )


@query(
    "home_away_roles",
    """with games as (select o_orderkey, c_nationkey as home, o_custkey % 25 as away
                      from orders join customer on o_custkey = c_custkey)
       select o_orderkey, home as "Team", away as "Opponent", true as "Home" from games
       union all select o_orderkey, away, home, false from games""",
)
def roles(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    games = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    both = home_away_roles(
        F.col("c_nationkey").cast("bigint"), F.col("o_custkey") % 25
    )
    return games.select("o_orderkey", F.inline(both))


@query("filter_eq", "select * from lineitem where l_returnflag = 'R'")
def filter_eq(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")


@query(
    "filter_ne",
    """select o_orderkey, o_orderstatus, month(o_orderdate) as round from orders
       where o_orderstatus <> 'F' and month(o_orderdate) <> 12""",
)
def filter_ne(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .where((F.col("o_orderstatus") != "F") & (F.month("o_orderdate") != 12))
        .select(
            "o_orderkey",
            "o_orderstatus",
            F.month("o_orderdate").cast("bigint").alias("round"),
        )
    )


@query(
    "filter_not_null",
    """select d.doc_id, quality from documents d left join labels l on d.doc_id = l.doc_id
       where quality is not null""",
)
def filter_not_null(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id", "left").where(F.col("quality").isNotNull())


@query(
    "blank_to_zero",
    """select o_orderkey,
         case when o_orderpriority = '5-LOW' then 0 else month(o_orderdate) end as plus_minus
       from orders""",
)
def blank(spark, sf_dir):
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(
        F.month("o_orderdate").cast("string")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", to_number(blank_to_zero(text), "bigint").alias("plus_minus")
    )


@query(
    "cast_types",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber::smallint as line_number,
              floor(l_extendedprice)::bigint as price_number, l_discount::float as discount,
              l_quantity as quantity from lineitem""",
)
def cast_types(spark, sf_dir):
    price = F.floor("l_extendedprice").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey",
        to_number(F.col("l_linenumber").cast("string"), "smallint").alias("line_number"),
        to_number(price, "bigint").alias("price_number"),
        to_number(F.col("l_discount").cast("string"), "float").alias("discount"),
        to_number(
            money("l_quantity").cast("string"), "decimal(18,2)", strict=False
        ).cast("double").alias("quantity"),
    )


@query(
    "percent_to_ratio",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
              case when l_returnflag <> 'N' then
                cast(round(l_discount * 1000) as bigint)::double / 1000 end as ratio
       from lineitem""",
)
def percent(spark, sf_dir):
    tenths = F.round(F.col("l_discount") * 1000).cast("bigint")
    text = F.when(F.col("l_returnflag") == "N", F.lit("-")).otherwise(
        F.concat((tenths / 10).cast("decimal(9,1)").cast("string"), F.lit("%"))
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        percent_to_ratio(text).cast("double").alias("ratio"),
    )


@query(
    "clock_to_seconds",
    """select event_id, case when event_type <> 'error'
         then (minute(ts) * 60 + second(ts))::double end as seconds from events""",
)
def clock(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", F.lit("DNP")).otherwise(
        F.date_format("ts", "m:ss")
    )
    return table(spark, sf_dir, "events").select(
        "event_id", clock_to_seconds(text).cast("double").alias("seconds")
    )


@query(
    "parse_date",
    "select o_orderkey, o_orderdate::date::varchar as game_date from orders",
)
def date(spark, sf_dir):
    text = F.date_format("o_orderdate", "d MMM yyyy")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", parse_date(text).cast("string").alias("game_date")
    )


@query(
    "season_label",
    """select o_orderkey,
              (year(o_orderdate) - 2000)::varchar || '_' || (year(o_orderdate) - 1999)::varchar
                as file_label,
              year(o_orderdate)::varchar || '-' || (year(o_orderdate) % 100 + 1)::varchar
                as site_label from orders""",
)
def season_label(spark, sf_dir):
    year = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        season_name(year).alias("file_label"),
        season_site_label(year).alias("site_label"),
    )


@query(
    "unpivot_long",
    """select s_suppkey, 'nation' as stat, s_nationkey::double as value from supplier
       union all select s_suppkey, 'balance', s_acctbal from supplier""",
)
def unpivot(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.col("s_nationkey").cast("double").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    return unpivot_long(supplier, ["s_suppkey"], ["nation", "balance"], "stat", "value")


EVENT_TYPES = ["click", "view", "error", "signup", "purchase"]


@query(
    "pivot_wide",
    """select user_id, (max(value) filter (event_type = 'click')) as click,
              (max(value) filter (event_type = 'view')) as view,
              (max(value) filter (event_type = 'error')) as error,
              (max(value) filter (event_type = 'signup')) as signup,
              (max(value) filter (event_type = 'purchase')) as purchase
       from events group by user_id""",
)
def pivot(spark, sf_dir):
    """Largest value per user and type, then one column per type."""
    largest = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", "event_type")
        .agg(F.max("value").alias("value"))
    )
    return pivot_wide(largest, ["user_id"], "event_type", "value", EVENT_TYPES)


@query(
    "transpose",
    """with sums as (
         select season, l_returnflag as flag, sum(l_quantity::decimal(18,2))::double as quantity,
                sum(l_tax::decimal(18,2))::double as tax
         from (select year(l_shipdate) as season, * from lineitem) a group by all)
       select season, stat, (max(v) filter (flag = 'A')) as "A", (max(v) filter (flag = 'N')) as "N",
              (max(v) filter (flag = 'R')) as "R"
       from (select season, flag, 'quantity' as stat, quantity as v from sums
             union all select season, flag, 'tax', tax from sums) b group by season, stat""",
)
def transposed(spark, sf_dir):
    sums = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.year("l_shipdate").cast("bigint").alias("season"),
            F.col("l_returnflag").alias("flag"),
        )
        .agg(
            F.sum(money("l_quantity")).cast("double").alias("quantity"),
            F.sum(money("l_tax")).cast("double").alias("tax"),
        )
    )
    return transpose(sums, ["season"], "flag", ["quantity", "tax"], "stat")
