"""Salary bounds out of free text."""

from string import digits

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_decimal(c: Column) -> Column:
    """NUMERIC(38, 9), null where the text is no number or too large."""
    return c.try_cast("decimal(38,9)")


def _digits_and_dashes(salary: Column) -> Column:
    return F.regexp_replace(F.lower(salary), f"[^{digits}–-]+", "")


def salary_min(salary: Column) -> Column:
    """The leading digits once all but digits and dashes is removed.

    Separators vanish, decimal points too: "$5,000.50" is 500050.
    """
    return safe_decimal(F.regexp_extract(_digits_and_dashes(salary), r"^(\d+)", 1))


def salary_max(salary: Column) -> Column:
    """The digits after a dash at the very end; null for a single value."""
    return safe_decimal(F.regexp_extract(_digits_and_dashes(salary), r"[–-](\d+)$", 1))
