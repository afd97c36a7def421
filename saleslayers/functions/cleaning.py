"""Text cleaning rules as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns the cleaning rules are defined by.
NON_DIGIT = "[^0-9]"
EMAIL_ADDRESS = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def null_if_not_digits(column: Column) -> Column:
    """The value, or NULL when its text holds anything but digits.

    The whole value is dropped, nothing is stripped. Numbers are compared through their
    text, so for an integer column only negative values become NULL.
    """
    return F.when(~column.cast("string").rlike(NON_DIGIT), column)


def null_if_not_email(column: Column) -> Column:
    """The value, or NULL when it does not look like an e-mail address."""
    return F.when(column.rlike(EMAIL_ADDRESS), column)
