"""Safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage rounded half up; NULL when the base is zero."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, NULL when the base is zero or missing."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def div0(a: Column, b: Column) -> Column:
    """Quotient, 0 when the divisor is zero; NULL passes through."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / F.nullif(b, F.lit(0)))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))
