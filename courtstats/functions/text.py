"""Text functions on columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_text(text: Column) -> Column:
    """Remove whitespace of any kind, no-break space included, at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def first_match(text: Column, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern`` (or one group of it), null when there is none."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def match_groups(text: Column, pattern: str, names: list[str]) -> Column:
    """Struct of all groups of the first match; every field null without one."""
    return F.struct(
        *[
            first_match(text, pattern, i).alias(name)
            for i, name in enumerate(names, start=1)
        ]
    )


def starts_with_pattern(text: Column, pattern: str) -> Column:
    """True when ``pattern`` matches at the start of the text."""
    return text.rlike(f"^(?:{pattern})")


def blank_to_zero(text: Column) -> Column:
    """The empty string becomes "0"; null stays null."""
    return F.when(text == "", F.lit("0")).otherwise(text)


def concat_key(*parts: Column) -> Column:
    """Bare concatenation of the parts as text; null when any part is null."""
    return F.concat(*[p.cast("string") for p in parts])
