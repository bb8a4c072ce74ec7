"""Invariant checks on the attribution tables.  An empty result means healthy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark import config as c
from trailmark.functions.combine import union_all

_CONVERSION = ["user_id", "converted_at", "conversion_index"]


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def _moment(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def _violations(df: DataFrame, broken: Column, context: Column, assertion: Column) -> DataFrame:
    return df.filter(broken).select("user_id", context.alias("context"), assertion.alias("assertion"))


def revenue_integrity(mart: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Model pairs of a conversion whose totals differ.

    Only the distributing models must agree; Full Credit repeats the revenue per channel.
    Conversions whose models all agree are dropped on their spread before pairs are formed, and a
    conversion has four totals at most, so the pairing stays small.
    """
    sums = (
        mart.filter(F.col("attribution_model").isin(*c.DISTRIBUTING_MODELS))
        .groupBy(*_CONVERSION, "attribution_model")
        .agg(F.round(F.sum("attributed_revenue"), 2).alias("revenue"))
    )
    cell = F.struct(F.col("attribution_model").alias("model"), F.col("revenue"))
    # At most four entries per conversion.
    apart = (
        sums.groupBy(*_CONVERSION)
        .agg(F.collect_list(cell).alias("cells"), (F.max("revenue") - F.min("revenue")).alias("spread"))
        .filter(F.col("spread") > tolerance)
    )
    pairs = apart.select(*_CONVERSION, "cells", F.explode("cells").alias("a")).select(
        *_CONVERSION, "a", F.explode("cells").alias("b")
    )
    differ = F.abs(F.col("a.revenue") - F.col("b.revenue")) > tolerance
    return pairs.filter((F.col("a.model") < F.col("b.model")) & differ).select(
        *_CONVERSION, F.col("a.model").alias("model_a"), F.col("a.revenue").alias("revenue_a"),
        F.col("b.model").alias("model_b"), F.col("b.revenue").alias("revenue_b"),
        F.lit("Revenue mismatch between models").alias("assertion"),
    )


def unexpected(rows: DataFrame, expected: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Rows that equal none of the expected value tuples; NULL equals NULL."""
    tuples = [reduce(and_, [F.col(c).eqNullSafe(v) for c, v in one.items()]) for one in expected]
    return rows.filter(~reduce(or_, tuples)) if tuples else rows


def absent(sets: Mapping[str, DataFrame]) -> DataFrame:
    """Names of the sets that hold no row, each counted as a scalar."""
    return union_all([df.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit(name).alias("absent")) for name, df in sets.items()])


def session_ordering(mart: DataFrame) -> DataFrame:
    """Touchpoints precede conversions and session numbers run from 1 to the path length."""
    rows = mart.filter(F.col("attribution_model") == c.LINEAR)
    stats = rows.groupBy(*_CONVERSION).agg(
        F.min("session_number").alias("lo"), F.max("session_number").alias("hi"),
        F.max("total_sessions_for_conversion").alias("declared"),
    )
    row_checks = [
        (F.col("session_start_time") >= F.col("converted_at"), F.lit("session_start_time >= converted_at")),
        (F.col("session_number") > F.col("total_sessions_for_conversion"),
         F.concat(F.lit("session_number="), _text("session_number"), F.lit(" > total_sessions="),
                  _text("total_sessions_for_conversion"))),
    ]
    path_checks = [
        (F.col("lo") != 1, F.concat(F.lit("min(session_number)="), _text("lo"), F.lit(", expected 1"))),
        (F.col("hi") != F.col("declared"),
         F.concat(F.lit("max(session_number)="), _text("hi"), F.lit(" but total_sessions_for_conversion="), _text("declared"))),
    ]
    return _broken(rows, row_checks).unionByName(_broken(stats, path_checks, _moment("converted_at")))


def completeness(
    mart: DataFrame, models: Sequence[str] = c.ALL_MODELS, allow_unpaid: bool = False
) -> DataFrame:
    """Every conversion has all models, no duplicate (session, conversion, model), no unknown model.

    Conversions without positive revenue only have Full Credit rows and are reported, unless
    ``allow_unpaid``.
    """
    expected = len(models)
    counts = mart.groupBy(*_CONVERSION).agg(
        F.countDistinct("attribution_model").alias("found"),
        F.max("attributed_revenue").alias("top"),
    )
    partial = F.col("found") != expected
    if allow_unpaid:
        partial = partial & (F.col("top") > 0)
    repeats = mart.groupBy("user_id", "session_id", "converted_at", "attribution_model").count()
    return union_all([
        _violations(counts, partial, _moment("converted_at"),
                    F.concat(F.lit("only "), _text("found"), F.lit(f" of {expected} attribution models present"))),
        _violations(repeats, F.col("count") > 1, F.col("session_id"),
                    F.concat(F.lit("duplicate row for model="), F.col("attribution_model"),
                             F.lit(" converted_at="), _moment("converted_at"))),
        _violations(mart, ~F.col("attribution_model").isin(list(models)), F.col("session_id"),
                    F.concat(F.lit('unexpected attribution_model value: "'), F.col("attribution_model"), F.lit('"'))),
    ])


def value_integrity(mart: DataFrame, touchpoints: DataFrame) -> DataFrame:
    """Column bounds, mandatory values and flag consistency, found in one pass per table."""
    last = F.col("session_number") == F.col("total_sessions_for_conversion")
    checks = [
        (F.col("attributed_revenue") < 0,
         F.concat(F.lit("attributed_revenue is negative: "), F.col("attributed_revenue").cast("decimal(38,2)").cast("string"))),
        (F.col("session_number") < 1, F.concat(F.lit("session_number < 1: "), _text("session_number"))),
        (F.col("total_sessions_for_conversion") < 1,
         F.concat(F.lit("total_sessions_for_conversion < 1: "), _text("total_sessions_for_conversion"))),
        (F.col("medium").isNull(), F.lit("medium is NULL")),
        (F.col("source").isNull(), F.lit("source is NULL")),
        (F.col("is_conversion_session") != last,
         F.concat(F.lit("is_conversion_session flag inconsistent: flag="), _text("is_conversion_session"),
                  F.lit(" session_number="), _text("session_number"), F.lit(" total="),
                  _text("total_sessions_for_conversion"))),
    ]
    point_checks = [
        (F.col("medium").isNull(), F.lit("medium is NULL in touchpoints")),
        (F.col("source").isNull(), F.lit("source is NULL in touchpoints")),
    ]
    return _broken(mart, checks).unionByName(_broken(touchpoints, point_checks))


def _broken(df: DataFrame, checks: list[tuple[Column, Column]], context: Column | None = None) -> DataFrame:
    found = F.filter(F.array(*[F.when(bad, text) for bad, text in checks]), lambda x: x.isNotNull())
    at = F.col("session_id") if context is None else context
    return df.select("user_id", at.alias("context"), F.explode(found).alias("assertion"))
