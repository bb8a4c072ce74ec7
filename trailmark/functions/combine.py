"""Putting small results together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(parts: Sequence[DataFrame], fill: bool = False) -> DataFrame:
    """Rows of all parts by column name; ``fill`` puts NULL where a part lacks a column."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), parts)


def beside(parts: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Columns of several aggregates next to each other.

    Each part has at most one row per ``by`` group, so stacking them and taking the only value
    present equals a full outer join on ``by`` that treats NULLs as equal (and, without ``by``,
    setting one-row results side by side).
    """
    columns = [c for p in parts for c in p.columns if c not in by]
    return union_all(parts, fill=True).groupBy(*by).agg(*[F.max(c).alias(c) for c in columns])
