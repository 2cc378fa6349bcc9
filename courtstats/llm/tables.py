"""Reading the given tables, and small helpers of several operators."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def text_key(text="text"):
    """A strong digest that stands for a whole text; null counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(column, F.lit("")).cast("binary"), 256))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``text_key, text`` once for each text (null: empty).

    Copies are dropped in the reading tasks already, so a text that fills a third
    of the table does not pile up in one task.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select(text_key().alias("text_key"), text).groupBy("text_key").agg(
        F.first("text").alias("text")
    )


def numbered(df: DataFrame) -> DataFrame:
    """The same columns named ``c0, c1, ..``: what is added cannot clash with them."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def with_key(docs: DataFrame, text: str = "text") -> DataFrame:
    """``numbered`` columns and ``text_key``, the digest of the whole text."""
    plain = numbered(docs)
    return plain.withColumn("text_key", text_key(F.col(f"c{docs.columns.index(text)}")))


def rows_without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has no ``text_key`` in ``found``; columns as they were."""
    left = with_key(docs).join(found.select("text_key"), "text_key", "left_anti")
    return left.drop("text_key").toDF(*docs.columns)
