"""Repair of numbers whose thousands dots were misplaced when they were exported as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _checked(value: Column, text: Column, dtype: str, strict: bool) -> Column:
    if not strict:
        return value
    broken = F.raise_error(F.concat(F.lit("cannot repair number: "), text)).cast(dtype)
    return F.when(text.isNotNull() & value.isNull(), broken).otherwise(value)


def gdp_number(text: Column, strict: bool = True) -> Column:
    """Whole number left after removing every dot."""
    value = F.replace(text, F.lit("."), F.lit("")).try_cast("bigint")
    return _checked(value, text, "bigint", strict)


def index_number(text: Column, strict: bool = True) -> Column:
    """Index value near 100 rebuilt from its first two dot groups.

    A leading ``1`` marks a value of 100 or more (three whole digits), anything
    else is below 100 (two whole digits). A first group that is already long
    enough fixes the decimal point by itself; below 100 only its last digit is
    kept as the decimal.
    """
    groups = F.split(text, r"\.")
    head = F.get(groups, F.lit(0))
    second = F.get(groups, F.lit(1))
    joined = F.concat(head, second)
    hundreds = head.startswith("1")
    long_head = F.length(head) > 2

    def point_after(s: Column, digits: int) -> Column:
        return F.concat(F.substring(s, 1, digits), F.lit("."), F.substr(s, F.lit(digits + 1)))

    repaired = (
        F.when(hundreds & long_head, F.concat(head, F.lit("."), second))
        .when(hundreds, point_after(joined, 3))
        .when(long_head, F.concat(F.substring(head, 1, 2), F.lit("."), F.right(head, F.lit(1))))
        .otherwise(point_after(joined, 2))
    )
    return _checked(repaired.try_cast("double"), text, "double", strict)
