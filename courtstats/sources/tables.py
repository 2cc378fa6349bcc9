"""Parquet tables, season sheets, stored pages and the season sink."""

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtstats.fixed import LINK_SEASON, SHEET_KEY, SHEET_STATS
from courtstats.functions.text import first_match
from courtstats.functions.values import season_name
from courtstats.operators.reshape import union_all

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)


def sheet_schema(further: list[str] = ()) -> T.StructType:
    """The columns to take from a sheet, wherever they stand in it."""
    return T.StructType(
        [T.StructField(SHEET_KEY, T.StringType())]
        + [T.StructField(c, T.DoubleType()) for c in SHEET_STATS]
        + [T.StructField(c, T.StringType()) for c in further]
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_pages(
    spark: SparkSession, path: str, start_year: int | None = None
) -> DataFrame:
    """Stored pages with the season of a given start year or of their link."""
    pages = spark.read.schema(PAGE_SCHEMA).parquet(path)
    return with_page_season(pages, start_year)


def with_page_season(pages: DataFrame, start_year: int | None = None) -> DataFrame:
    """Add ``Season`` from a given start year or from the page's link."""
    year = (
        F.lit(start_year)
        if start_year is not None
        else first_match(F.col("url"), LINK_SEASON, 1)
    )
    return pages.withColumn("Season", season_name(year))


def read_sheet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    strict: bool = True,
) -> DataFrame:
    """The columns of a schema from a season sheet exported to CSV, by name.

    Every file has its own header; columns are matched by name, so files may differ
    in their order and in further columns, which are passed over. A column that is
    absent raises. Strict raises on text that is no value of the column's type,
    otherwise it is null.
    """
    schema = schema or sheet_schema()
    files = files_by_header(spark, path)
    # One read for each different header; with one header the folder is read whole.
    reads = list(files.values()) if len(files) > 1 else [path]
    text = [
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("basePath", path)
        .csv(names)
        for names in reads
    ]
    for df in text:
        absent = [f.name for f in schema if f.name not in df.columns]
        if absent:
            raise ValueError(f"the sheet has no column {', '.join(absent)}")
    columns = [_typed(f, strict).alias(f.name) for f in schema]
    return union_all(*[df.select(*columns) for df in text])


def files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a folder by their first line; one row a file reaches the driver."""
    lines = spark.read.text(path).select(
        "value", "_metadata.file_path", "_metadata.file_block_start"
    )
    # The first block of a file is read by one task, from its first line on.
    first = lines.where("file_block_start = 0").groupBy("file_path").agg(F.first("value").alias("header"))
    files = {}
    for row in sorted(first.collect()):
        files.setdefault(row.header, []).append(unquote(row.file_path))
    return files


def _typed(field: T.StructField, strict: bool) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return column
    kind = field.dataType.simpleString()
    return column.cast(kind) if strict else column.try_cast(kind)


def read_season_sheets(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | None = None,
    strict: bool = True,
) -> DataFrame:
    """As ``read_sheet`` for a folder with ``Season=..`` subfolders.

    The season is a column, and only the seasons asked for are read.
    """
    schema = schema or sheet_schema()
    with_season = T.StructType(schema.fields + [T.StructField("Season", T.StringType())])
    return read_sheet(spark, folder, with_season, strict)


def write_sheet(df: DataFrame, path: str, partition: str | None = None) -> None:
    """A CSV folder, or one per value of ``partition``.

    Rows of a value meet in one task first, or every task would write a file into
    every folder: a sheet has few rows, and files that small cost more than they hold.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    writer = (df.repartition(tasks, partition) if partition else df).write.option("header", True)
    if partition:
        writer = writer.partitionBy(partition)
    writer.csv(path)


def write_seasons(df: DataFrame, path: str, season: str = "Season") -> None:
    """Parquet folder per season.

    Only the seasons in ``df`` are written anew; others in the folder stay. The
    rebalance hint gives few files per season and splits a season that is much
    larger than the others over several tasks.
    """
    (
        df.hint("rebalance", season)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(season)
        .parquet(path)
    )


def read_season(
    spark: SparkSession, path: str, season_value: str, season: str = "Season"
) -> DataFrame:
    """One season of a season folder; other seasons are not listed or read."""
    return spark.read.parquet(path).where(F.col(season) == season_value)
