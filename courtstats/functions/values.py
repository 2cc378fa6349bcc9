"""Typed values: numbers, clocks, dates, rounds and season names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtstats.fixed import CLOCK, DATE_FORMAT, PERCENT
from courtstats.functions.text import blank_to_zero, first_match, strip_text


def to_number(text: Column, data_type: str = "smallint", strict: bool = True) -> Column:
    """Cast text to a number. Strict raises on bad text, otherwise it is null."""
    return text.cast(data_type) if strict else text.try_cast(data_type)


def percent_to_ratio(text: Column, strict: bool = True) -> Column:
    """First number of a text such as ``54.5%`` as a ratio, to six digits of the percent."""
    number = to_number(first_match(text, PERCENT, 1), "decimal(18,6)", strict)
    return (number / 100).cast("decimal(18,8)")


def percent_number_to_ratio(value: Column) -> Column:
    return value / 100


def clock_to_seconds(clock: Column) -> Column:
    """``M:S`` as seconds, null when the text holds no clock."""
    minutes = first_match(clock, CLOCK, 1).cast("bigint")
    seconds = first_match(clock, CLOCK, 2).cast("bigint")
    return minutes * 60 + seconds


def plus_minus(text: Column, strict: bool = True) -> Column:
    """Signed number with an empty cell read as zero."""
    return to_number(blank_to_zero(text), "smallint", strict)


def parse_date(text: Column, strict: bool = True) -> Column:
    """Date from a text such as ``7 Oct 2022``."""
    parse = F.to_date if strict else F.try_to_date
    return parse(strip_text(text), DATE_FORMAT)


def previous_round(round_number: Column) -> Column:
    """The round before; the first round stands for itself."""
    before = round_number.cast("int") - 1
    return F.when(before == 0, F.lit(1)).otherwise(before)


def season_name(start_year: Column, separator: str = "_") -> Column:
    """2022 -> ``22_23`` without zero padding."""
    first = (start_year.cast("int") - 2000).cast("string")
    second = (start_year.cast("int") - 1999).cast("string")
    return F.concat(first, F.lit(separator), second)


def season_site_label(start_year: Column) -> Column:
    """2022 -> ``2022-23``: last two digits plus one, without zero padding."""
    year = start_year.cast("string")
    return F.concat(
        year, F.lit("-"), (F.substring(year, -2, 2).cast("int") + 1).cast("string")
    )
