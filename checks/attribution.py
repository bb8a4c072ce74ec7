"""Staging, touchpoints, conversions, the attribution mart and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import CFG, SHORT, Build
from trailmark.config import ALL_MODELS, AttributionConfig, work_table
from trailmark.functions.traffic import campaign_params
from trailmark.operators import attribution, conversions, quality, touchpoints
from trailmark.sources import staging
from trailmark.sources.landing import Star


def points(t: Star, cfg: AttributionConfig = CFG) -> DataFrame:
    return touchpoints.touchpoints(t["events"], t["source_properties"], t["users"], cfg)


def convs(t: Star, cfg: AttributionConfig = CFG) -> DataFrame:
    return conversions.conversions(t["custom_events"], t["users"], cfg)


def stored(t: Star, cfg: AttributionConfig = CFG) -> tuple[DataFrame, DataFrame]:
    """Touchpoints and conversions as materialised tables, which the mart reads."""
    return work_table(points(t, cfg), "touchpoints"), work_table(convs(t, cfg), "conversions")


def weights(t: Star, cfg: AttributionConfig = CFG) -> DataFrame:
    return attribution.weighted_paths(*stored(t, cfg), cfg, extra=("conversion_index",))


def mart(t: Star, cfg: AttributionConfig = CFG, models=ALL_MODELS) -> DataFrame:
    return attribution.mart_from_weights(weights(t, cfg), models)


def indexed_mart(t: Star) -> DataFrame:
    return work_table(attribution.mart_from_weights(weights(t), extra=("conversion_index",)), "mart")


def corrupted(m: DataFrame) -> DataFrame:
    """A mart with planted faults: missing model rows, duplicates, shifted numbers, negative
    revenue, unknown model names, missing channels, late touchpoints."""
    pick = lambda n: F.pmod(F.length("session_id") + F.col("conversion_index") * 7 + F.dayofmonth("session_start_time"), F.lit(n))
    linear = F.col("attribution_model") == "Linear"
    kept = m.filter(~((F.col("attribution_model") == "Last Touch") & (pick(11) == 3)))
    doubled = kept.unionByName(kept.filter((F.col("attribution_model") == "First Touch") & (pick(13) == 2)))
    return doubled.select(
        "user_id", "session_id",
        F.when(linear & (pick(17) == 4), F.col("converted_at")).otherwise(F.col("session_start_time")).alias("session_start_time"),
        "converted_at",
        F.when(pick(19) == 1, None).otherwise(F.col("source")).alias("source"),
        F.when(pick(23) == 1, None).otherwise(F.col("medium")).alias("medium"),
        "campaign", "total_sessions_for_conversion",
        F.when(linear & (pick(5) == 1), F.col("session_number") - 1)
        .when(linear & (pick(5) == 2), F.col("session_number") + 1)
        .otherwise(F.col("session_number")).alias("session_number"),
        "is_conversion_session",
        F.when((F.col("attribution_model") == "Full Credit") & (pick(29) == 5), "Half Credit")
        .otherwise(F.col("attribution_model")).alias("attribution_model"),
        F.when(pick(31) == 6, -F.col("attributed_revenue")).otherwise(F.col("attributed_revenue")).alias("attributed_revenue"),
        "conversion_index",
    )


def broken_mart(t: Star) -> DataFrame:
    return work_table(corrupted(indexed_mart(t)), "broken")


def k07a(t: Star) -> DataFrame:
    return touchpoints.classified_events(t["events"], t["source_properties"], CFG).select(
        "event_id", "source", "medium", "campaign")


def k07a_strict(t: Star) -> DataFrame:
    strict = CFG.but(strict_reference=True)
    return (touchpoints.classified_events(t["events"], t["source_properties"], strict)
            .groupBy("source", "medium", "campaign").agg(F.count(F.lit(1)).alias("events")))


def k07b(t: Star) -> DataFrame:
    return t["source_properties"].select(
        "event_id", *[c.alias(n) for n, c in campaign_params(F.col("url_full_url")).items()])


def k08_integer_price(t: Star) -> DataFrame:
    return convs(t, SHORT.but(price_scale=0))


def k09(t: Star) -> DataFrame:
    return attribution.attributed_sessions(*stored(t), CFG)


def j09(t: Star) -> DataFrame:
    return attribution.interval_join(*stored(t), CFG)


def k10(t: Star) -> DataFrame:
    return attribution.path_metadata(work_table(attribution.attributed_sessions(*stored(t), CFG), "linked"))


def one_model(model: str) -> Build:
    return lambda t: mart(t, models=(model,))


def k26(t: Star) -> DataFrame:
    return attribution.channel_performance(mart(t))


ATTRIBUTION: dict[str, Build] = {
    "k07_touchpoints": points,
    "k07_touchpoints_short_lookback": lambda t: points(t, SHORT),
    "k07a_traffic_classes": k07a,
    "k07a_traffic_classes_strict": k07a_strict,
    "k07b_url_parameters": k07b,
    "k08_conversions": convs,
    "k08_conversions_short_integer_price": k08_integer_price,
    "k09_attributed_sessions": k09,
    "j9_interval_join": j09,
    "k10_path_metadata": k10,
    "k11_first_touch": one_model("First Touch"),
    "k12_last_touch": one_model("Last Touch"),
    "k13_linear": one_model("Linear"),
    "k14_u_shaped": one_model("40-20-40 U-Shaped"),
    "k15_full_credit": one_model("Full Credit"),
    "k15_full_credit_latest": lambda t: attribution.full_credit(weights(t), representative="latest").select(
        *attribution.MART_COLUMNS),
    "k16_attribution_mart": mart,
    "k16_attribution_mart_short_windows": lambda t: mart(t, SHORT),
    "k17_revenue_integrity": lambda t: quality.revenue_integrity(indexed_mart(t)),
    "k17_revenue_integrity_broken": lambda t: quality.revenue_integrity(broken_mart(t)),
    "k18_session_ordering": lambda t: quality.session_ordering(indexed_mart(t)),
    "k18_session_ordering_broken": lambda t: quality.session_ordering(broken_mart(t)),
    "k19_completeness": lambda t: quality.completeness(indexed_mart(t)),
    "k19_completeness_broken": lambda t: quality.completeness(broken_mart(t)),
    "k20_value_integrity": lambda t: quality.value_integrity(indexed_mart(t), points(t)),
    "k20_value_integrity_broken": lambda t: quality.value_integrity(
        broken_mart(t), points(t).withColumn("medium", F.nullif(F.col("medium"), F.lit("direct")))),
    "k26_channel_performance": k26,
}

STAGING: dict[str, Build] = {
    "s4_stage_events": lambda t: staging.stage_events(t["events"]),
    "s5_stage_source_properties": lambda t: staging.stage_source_properties(t["source_properties"]).drop("event_time"),
    "s6_stage_users": lambda t: staging.stage_users(t["users"]),
    "s7_stage_custom_events": lambda t: staging.stage_custom_events(t["custom_events"]),
}
