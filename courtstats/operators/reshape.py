"""Reshaping: union, wide and long forms, roles, positions, ordered distinct."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def unpivot_long(
    df: DataFrame, keys: list[str], columns: list[str], name: str, value: str
) -> DataFrame:
    """One row per key and column."""
    return df.unpivot(
        [F.col(f"`{k}`") for k in keys], [F.col(f"`{c}`") for c in columns], name, value
    )


#: Columns that labels found in the data may become.
MOST_LABELS = 1000


def labels_of(df: DataFrame, name: str, most: int = MOST_LABELS) -> list:
    """The different values of a column in order, without null; more than ``most`` raise."""
    column = F.col(f"`{name}`")
    found = df.where(column.isNotNull()).select(column).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{name} has more than {most} different values")
    return sorted(r[0] for r in found)


def pivot_wide(
    df: DataFrame, keys: list[str], name: str, value: str, labels: list | None = None
) -> DataFrame:
    """One row per key and one column per label.

    Each task reduces its rows before the shuffle. With given labels no extra pass
    looks for them, and a value that is not among them raises; without, they are the
    values that the data have.
    """
    if labels is None:
        labels = labels_of(df, name)
    outside = F.concat(F.lit(f"not a label of {name}: "), F.col(f"`{name}`").cast("string"))
    known = F.col(f"`{name}`").isin(labels) | F.col(f"`{name}`").isNull()
    return (
        df.withColumn(name, F.when(known, F.col(f"`{name}`")).otherwise(F.raise_error(outside)))
        .groupBy(*[F.col(f"`{k}`") for k in keys])
        .pivot(name, labels)
        .agg(F.first(F.col(f"`{value}`"), ignorenulls=True))
    )


def transpose(
    df: DataFrame,
    keys: list[str],
    label: str,
    columns: list[str],
    header: str,
    labels: list | None = None,
) -> DataFrame:
    """Columns become rows and the values of ``label`` become columns.

    Without ``labels`` they are looked for among the rows, before these are
    multiplied by the columns.
    """
    if labels is None:
        labels = labels_of(df, label)
    long = unpivot_long(df, keys + [label], columns, header, "_value")
    return pivot_wide(long, keys + [header], label, "_value", labels)


def label_at(labels: list[str], position: Column) -> Column:
    """Label of a zero-based position; a position beyond the list raises."""
    label = F.get(F.array(*[F.lit(x) for x in labels]), position)
    beyond = F.raise_error(F.concat(F.lit("no label for position "), position.cast("string")))
    return F.when(position < len(labels), label).when(position.isNotNull(), beyond)


def home_away_roles(home: Column, away: Column, **extra: tuple) -> Column:
    """Two role structs per game: the home side, then the away side.

    ``extra`` gives further fields as pairs (home value, away value).
    """
    def role(team, opponent, is_home, side):
        return F.struct(
            team.alias("Team"),
            opponent.alias("Opponent"),
            F.lit(is_home).alias("Home"),
            *[pair[side].alias(name) for name, pair in extra.items()],
        )

    return F.array(role(home, away, True, 0), role(away, home, False, 1))


def ordered_distinct(df: DataFrame, value: str, order: list[str]) -> DataFrame:
    """Distinct values with the order columns of their first occurrence.

    The minimum is taken before the shuffle, so a value that fills a third of
    the rows sends one row per task.
    """
    first = F.min(F.struct(*[F.col(c) for c in order])).alias("_first")
    return df.groupBy(value).agg(first).select(value, "_first.*")
