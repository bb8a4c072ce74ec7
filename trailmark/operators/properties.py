"""Discovery and profile of customer-defined property columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.combine import union_all

# Columns every property table has by itself.
RESERVED: dict[str, tuple[str, ...]] = {
    "user_properties": ("user_id", "last_updated_time", "processed_time", "updated_time"),
    "page_properties": ("event_id", "processed_time", "updated_time", "event_time"),
    "element_properties": ("event_id", "processed_time", "updated_time", "event_time"),
}


def custom_columns(table: str, df: DataFrame) -> list[str]:
    """Column names that are not reserved, compared without case."""
    reserved = RESERVED.get(table, ())
    return [c for c in df.columns if c.lower() not in reserved]


def property_profile(tables: Mapping[str, DataFrame], exact: bool = False) -> DataFrame:
    """One row per custom column: type, filled rows and distinct values, in one pass per table.

    Distinct values are estimated (fixed-size sketch per column) unless ``exact``.
    """
    distinct = F.countDistinct if exact else F.approx_count_distinct
    parts = []
    for table, df in tables.items():
        columns = custom_columns(table, df)
        if not columns:
            continue
        aggs = [a for i, c in enumerate(columns)
                for a in (F.count(c).alias(f"n{i}"), distinct(c).alias(f"d{i}"))]
        types = dict(df.dtypes)
        cells = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                     F.col(f"n{i}").alias("non_null_count"), F.col(f"d{i}").alias("approx_distinct"))
            for i, c in enumerate(columns)])
        parts.append(df.agg(*aggs).select(F.lit(table).alias("table_name"), F.inline(cells)))
    return union_all(parts)
