"""Number expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def half_up(value: Column | str) -> Column:
    """Nearest whole number, halves upwards."""
    return F.floor((F.col(value) if isinstance(value, str) else value) + 0.5).cast("int")


def parse_finite(text: Column | str) -> Column:
    """Text to double; null when it is not a finite number."""
    number = F.col(text).try_cast("double") if isinstance(text, str) else text.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def parse_int(text: Column | str) -> Column:
    """Text of digits with an optional sign to int; anything else, blanks included, gives null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c.rlike(r"^[+-]?\d+$"), c.try_cast("int"))


def ratio(top: Column, bottom: Column, digits: int) -> Column:
    """top/bottom rounded half up, null when bottom is 0."""
    return F.round(F.try_divide(top.cast("double"), bottom.cast("double")), digits)


def mean_star(stars: list[str], total: str, digits: int = 2) -> Column:
    """Weighted mean of star counts; 0.0 when there is no review."""
    weighted = reduce(lambda a, b: a + b, [F.col(c) * i for i, c in enumerate(stars)])
    return F.coalesce(ratio(weighted, F.col(total), digits), F.lit(0.0))


def mean_of(column: str, digits: int = 2) -> Column:
    return F.round(F.avg(column), digits)


def spread_of(column: str, digits: int = 2) -> Column:
    """Sample standard deviation; 0.0 for a single row."""
    return F.coalesce(F.round(F.stddev_samp(column), digits), F.lit(0.0))


def with_thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def count_or_zero(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))
