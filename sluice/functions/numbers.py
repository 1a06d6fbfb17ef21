"""Number formats of the JSON export and of the dashboard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_fraction(number: Column) -> Column:
    """True when the remainder by 1 is positive, so false for negative fractions."""
    return (number % 1) > 0


def json_float(number: Column) -> Column:
    """The number as a float if it has a fraction, else null."""
    return F.when(has_fraction(number), number.cast("double"))


def json_int(number: Column) -> Column:
    """The number as an integer if it has no (positive) fraction, else null."""
    return F.when(~has_fraction(number), number.cast("bigint"))


def thousands(number: Column) -> Column:
    """``1,234,567``."""
    return F.format_number(number, 0)
