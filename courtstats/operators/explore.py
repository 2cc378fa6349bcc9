"""Looking at a table: correlation, shape, schema, first rows, point sets."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pearson_corr(df: DataFrame, x: str, y: str, name: str) -> DataFrame:
    """Correlation of two columns; null when one of them is constant or empty."""
    return pearson_corrs(df, {name: (x, y)})


def pearson_corrs(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Correlations of several pairs of columns, by name, in one pass."""
    return df.agg(*[_correlation(x, y).alias(name) for name, (x, y) in pairs.items()])


def _correlation(x: str, y: str) -> Column:
    a, b = F.col(f"`{x}`").cast("double"), F.col(f"`{y}`").cast("double")
    both = a.isNotNull() & b.isNotNull()
    varies = (
        (F.count_if(both) > 1)
        & (F.min(F.when(both, a)) < F.max(F.when(both, a)))
        & (F.min(F.when(both, b)) < F.max(F.when(both, b)))
    )
    spread = F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b))
    return F.when(varies, F.try_divide(F.covar_pop(a, b), spread))


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns as one row."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


def schema_table(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and the table's row count."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return (
        df.agg(F.count("*").alias("n_rows"))
        .select(F.inline(fields), "n_rows")
    )


def head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First rows in a total order."""
    return df.orderBy(*[f"`{c}`" for c in order]).limit(n)


def scatter_points(df: DataFrame, x: str, y: str) -> DataFrame:
    """The drawable points: rows where both coordinates are known."""
    return df.select(f"`{x}`", f"`{y}`").dropna()
