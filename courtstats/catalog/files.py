"""Sources, sinks and looking at tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtstats.catalog.registry import query
from courtstats.catalog.tables import table
from courtstats.functions.values import season_name
from courtstats.operators.explore import (
    head,
    pearson_corrs,
    scatter_points,
    schema_table,
    shape,
)
from courtstats.sources.shared import new_path
from courtstats.sources.tables import read_season, read_sheet, write_seasons, write_sheet

SEASON_DUCK = (
    "(year(o_orderdate) - 2000)::varchar || '_' || (year(o_orderdate) - 1999)::varchar"
)
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def season_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        *ORDER_COLUMNS, season_name(F.year("o_orderdate")).alias("Season")
    )


@query("scan_parquet", "select * from orders")
def scan_parquet(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query(
    "parquet_roundtrip",
    f'select {", ".join(ORDER_COLUMNS)}, {SEASON_DUCK} as "Season" from orders',
)
def parquet_roundtrip(spark, sf_dir):
    path = new_path(spark, "orders-by-season")
    orders = season_orders(spark, sf_dir)
    write_seasons(orders, path)
    return spark.read.schema(orders.schema).parquet(path)


@query(
    "season_partition_scan",
    f"""select {", ".join(ORDER_COLUMNS)}, {SEASON_DUCK} as "Season" from orders
        where year(o_orderdate) = 2000""",
)
def season_partition_scan(spark, sf_dir):
    """The season is the path parameter; the folder holds all orders."""
    path = new_path(spark, "orders-by-season")
    write_seasons(season_orders(spark, sf_dir), path)
    return read_season(spark, path, "0_1")


@query(
    "season_rewrite",
    f"""select {", ".join(ORDER_COLUMNS)}, {SEASON_DUCK} as "Season" from orders
        where year(o_orderdate) in (1999, 2000)""",
)
def season_rewrite(spark, sf_dir):
    """Seasons written one at a time, the first one again: each keeps its rows once."""
    path = new_path(spark, "orders-by-season")
    orders = season_orders(spark, sf_dir)
    for season in ("-1_0", "0_1", "-1_0"):
        write_seasons(orders.where(F.col("Season") == season), path)
    return spark.read.schema(orders.schema).parquet(path)


@query("csv_dim_scan", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def csv_dim_scan(spark, sf_dir):
    """Two seasons of the sheet, each with a column order and further columns of its own."""
    path = new_path(spark, "supplier-sheet")
    supplier = table(spark, sf_dir, "supplier").withColumn("note", F.lit("x"))
    odd = F.col("s_suppkey") % 2 == 1
    first = ["s_acctbal", "note", *[c for c in supplier.columns[::-1] if c not in ("note", "s_acctbal")]]
    write_sheet(supplier.where(odd).select(first), f"{path}/Season=21_22")
    write_sheet(supplier.where(~odd).select("s_name", "s_suppkey", "s_nationkey", "s_acctbal"), f"{path}/Season=22_23")
    schema = T.StructType(
        [
            T.StructField("s_suppkey", T.LongType()),
            T.StructField("s_name", T.StringType()),
            T.StructField("s_nationkey", T.IntegerType()),
            T.StructField("s_acctbal", T.DoubleType()),
        ]
    )
    return read_sheet(spark, path, schema)


@query(
    "pearson_corr",
    """select round(corr(l_quantity, l_extendedprice), 9) as correlation,
              round(corr(l_quantity, l_discount), 9) as discount_correlation from lineitem""",
)
def correlation(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    columns = lineitem.select("l_quantity", "l_extendedprice", "l_discount")
    both = pearson_corrs(
        columns,
        {
            "correlation": ("l_quantity", "l_extendedprice"),
            "discount_correlation": ("l_quantity", "l_discount"),
        },
    )
    return both.select(*[F.round(c, 9).alias(c) for c in both.columns])


@query("row_count", "select count(*) as n_rows, 11::bigint as n_columns from lineitem")
def row_count(spark, sf_dir):
    return shape(table(spark, sf_dir, "lineitem"))


LINEITEM_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]


@query(
    "schema_table",
    "select position, column_name, data_type, n_rows from (values "
    + ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(LINEITEM_TYPES))
    + ") v(position, column_name, data_type), (select count(*) as n_rows from lineitem) c",
)
def schema_of_table(spark, sf_dir):
    return schema_table(table(spark, sf_dir, "lineitem"))


@query("scatter_points", "select l_quantity, l_extendedprice from lineitem")
def scatter(spark, sf_dir):
    return scatter_points(
        table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice"
    )


@query(
    "sort_by_date",
    """select o_orderkey, o_orderdate, o_totalprice from orders
       order by o_orderdate, o_orderkey""",
)
def sort_by_date(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderdate", "o_totalprice")
        .orderBy("o_orderdate", "o_orderkey")
    )


@query(
    "head_rows",
    """select o_orderkey, o_orderdate, o_totalprice from orders
       order by o_orderdate, o_orderkey limit 5""",
)
def head_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return head(orders, ["o_orderdate", "o_orderkey"])
