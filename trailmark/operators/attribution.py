"""Multi-touch attribution: paths, model weights, the long mart and its rollup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark import config as c
from trailmark.config import AttributionConfig, work_table
from trailmark.functions.combine import union_all
from trailmark.functions.numbers import div0
from trailmark.functions.time import days_before
from trailmark.operators.ordered import DAY, time_bucket, with_following_match, with_order

MART_COLUMNS = [
    "user_id", "session_id", "session_start_time", "converted_at", "source", "medium", "campaign",
    "total_sessions_for_conversion", "session_number", "is_conversion_session",
    "attribution_model", "attributed_revenue",
]
_TOUCH = ["session_id", "source", "medium", "campaign"]


def _window_start(cfg: AttributionConfig, converted_at: Column, previous: Column) -> tuple[Column, Column]:
    oldest = days_before(converted_at, cfg.attribution_window_days)
    return oldest, F.coalesce(previous, oldest)


def attributed_sessions(
    touchpoints: DataFrame, conversions: DataFrame, cfg: AttributionConfig, extra: Sequence[str] = ()
) -> DataFrame:
    """Touchpoints linked to the conversion they led to.

    A touchpoint may serve a conversion when it is earlier, within the attribution window, and not
    before the previous conversion.  As ``previous_conversion_at`` is the user's preceding
    conversion, these ranges never overlap: the only candidate is the next conversion.  So both
    inputs are put on one time line per user and each touchpoint looks up the following conversion
    in a single ordered pass, with no touchpoint x conversion pairs.  For ranges that do overlap
    use ``interval_join``.

    ``extra`` names conversion columns to carry, such as ``conversion_index``.
    """
    carried = ["converted_at", "conversion_revenue", "previous_conversion_at", *extra]
    # On equal times touchpoints come after conversions: a touchpoint must be strictly earlier.
    # Of conversions at one instant only the first in order has a non-empty range.
    tie = F.struct(F.col("previous_conversion_at").isNotNull().cast("int"), "previous_conversion_at")
    touch = touchpoints.select(
        "user_id", F.col("event_time").alias("at"), F.lit(1).alias("kind"),
        F.struct(*_TOUCH).alias("touch"),
    )
    conv = conversions.select(
        "user_id", F.col("converted_at").alias("at"), F.lit(0).alias("kind"),
        F.struct(tie.alias("rank"), *carried).alias("conv"),
    )
    line = touch.unionByName(conv, allowMissingColumns=True)
    matched = with_following_match(
        line, ["user_id"], "at", order=[F.col("at").desc(), F.col("kind").desc(), F.col("conv.rank").desc()],
        candidate=F.col("conv"), candidate_order=F.struct("at", "conv.rank"), out="target",
    )
    oldest, after_previous = _window_start(cfg, F.col("target.converted_at"), F.col("target.previous_conversion_at"))
    return matched.filter(
        (F.col("kind") == 1) & (F.col("at") >= oldest) & (F.col("at") >= after_previous)
    ).select(
        "user_id", "touch.session_id", F.col("at").alias("session_start_time"),
        "touch.source", "touch.medium", "touch.campaign",
        "target.converted_at", "target.conversion_revenue", *[f"target.{n}" for n in extra],
    )


def interval_join(
    touchpoints: DataFrame, conversions: DataFrame, cfg: AttributionConfig, extra: Sequence[str] = ()
) -> DataFrame:
    """The same linkage as a join on (user, day) with the range bounds as residual.

    Each conversion is repeated for the days its range covers (window length + 1 at most), so a
    busy user's rows spread over days and only meet conversions whose range touches that day.
    Works for any ranges, overlapping or not.
    """
    oldest, after_previous = _window_start(cfg, F.col("converted_at"), F.col("previous_conversion_at"))
    lower = F.greatest(oldest, after_previous)
    spans = (
        conversions.withColumn("_from", lower).filter(F.col("_from") < F.col("converted_at"))
        .withColumn("_day", F.explode(F.sequence(time_bucket(F.col("_from"), DAY), time_bucket(F.col("converted_at"), DAY))))
        .select("user_id", "_day", "_from", "converted_at", "conversion_revenue", *extra)
    )
    touch = touchpoints.withColumn("_day", time_bucket(F.col("event_time"), DAY))
    return (
        touch.join(spans, ["user_id", "_day"])
        .filter((F.col("event_time") < F.col("converted_at")) & (F.col("event_time") >= F.col("_from")))
        .select("user_id", "session_id", F.col("event_time").alias("session_start_time"), "source", "medium",
                "campaign", "converted_at", "conversion_revenue", *extra)
    )


def path_metadata(sessions: DataFrame) -> DataFrame:
    """Position in the path, path length, and whether this is the last session before converting."""
    sized = with_order(
        sessions, ["user_id", "converted_at"], "session_start_time", ["session_id"],
        position="session_number", size="total_sessions_for_conversion",
    )
    return sized.withColumn(
        "is_conversion_session", F.col("session_number") == F.col("total_sessions_for_conversion")
    )


def model_weights(paths: DataFrame) -> DataFrame:
    """One revenue column per distributing model, named after the model, as doubles."""
    n, total = F.col("session_number"), F.col("total_sessions_for_conversion")
    revenue = F.col("conversion_revenue").cast("double")
    share = {
        c.FIRST_TOUCH: F.when(n == 1, revenue).otherwise(F.lit(0.0)),
        c.LAST_TOUCH: F.when(n == total, revenue).otherwise(F.lit(0.0)),
        c.LINEAR: div0(F.lit(1.0), total) * revenue,
        c.U_SHAPED: (
            F.when(total == 1, revenue)
            .when(total == 2, 0.5 * revenue)
            .when((n == 1) | (n == total), 0.4 * revenue)
            .otherwise(div0(F.lit(0.2), total - 2) * revenue)
        ),
    }
    return paths.withColumns(share)


def distributed_credit(weights: DataFrame, models: Sequence[str] = c.DISTRIBUTING_MODELS) -> DataFrame:
    """Wide model columns to one row per session and model, in one pass; positive credit only."""
    ids = [x for x in weights.columns if x not in c.DISTRIBUTING_MODELS]
    return weights.unpivot(ids, list(models), "attribution_model", "attributed_revenue").filter(
        F.col("attributed_revenue") > 0
    )


def full_credit(weights: DataFrame, extra: Sequence[str] = (), representative: str = "max") -> DataFrame:
    """Every distinct channel of a path gets the whole revenue, once per conversion.

    The row shown for a channel takes each column's maximum separately; with
    ``representative="latest"`` all come from the channel's latest session.
    """
    shown = ["session_id", "session_start_time", "total_sessions_for_conversion", "session_number",
             "is_conversion_session"]
    keys = ["user_id", "source", "medium", "campaign", "converted_at", "conversion_revenue", *extra]
    if representative == "latest":
        aggs = [F.max_by(x, F.col("session_number")).alias(x) for x in shown]
    else:
        aggs = [F.max(x).alias(x) for x in shown]
    return (
        weights.groupBy(*keys).agg(*aggs)
        .withColumn("attribution_model", F.lit(c.FULL_CREDIT))
        .withColumn("attributed_revenue", F.col("conversion_revenue").cast("double"))
    )


def weighted_paths(
    touchpoints: DataFrame, conversions: DataFrame, cfg: AttributionConfig, extra: Sequence[str] = ()
) -> DataFrame:
    """Paths with model weights.  Linked sessions are written once: numbering reads them twice."""
    linked = work_table(attributed_sessions(touchpoints, conversions, cfg, extra), "linked")
    return model_weights(path_metadata(linked))


def mart_from_weights(
    weights: DataFrame, models: Sequence[str] = c.ALL_MODELS, extra: Sequence[str] = ()
) -> DataFrame:
    """The long fact from path weights.

    The distributing models and Full Credit each read the weights, so these are written first when
    both are wanted.
    """
    columns = [*MART_COLUMNS, *extra]
    if c.FULL_CREDIT in models and len(models) > 1:
        weights = work_table(weights, "weights")
    spread = [m for m in models if m != c.FULL_CREDIT]
    parts = []
    if spread:
        parts.append(distributed_credit(weights, spread).select(*columns))
    if c.FULL_CREDIT in models:
        parts.append(full_credit(weights, extra).select(*columns))
    return union_all(parts)


def attribution_mart(
    touchpoints: DataFrame, conversions: DataFrame, cfg: AttributionConfig,
    models: Sequence[str] = c.ALL_MODELS, extra: Sequence[str] = (),
) -> DataFrame:
    """The long fact: one row per session and model.  ``extra=("conversion_index",)`` adds the index."""
    return mart_from_weights(weighted_paths(touchpoints, conversions, cfg, extra), models, extra)


def channel_performance(mart: DataFrame) -> DataFrame:
    """Revenue and converting paths by model, channel and conversion week."""
    return (
        mart.withColumn("week", F.date_trunc("week", "converted_at"))
        .groupBy("attribution_model", "source", "medium", "campaign", "week")
        .agg(F.countDistinct("user_id", "converted_at").alias("conversions"),
             F.sum("attributed_revenue").alias("revenue"))
    )
