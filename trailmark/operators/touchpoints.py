"""Marketing touchpoints: the best traffic signal of each session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.config import AttributionConfig
from trailmark.functions import traffic
from trailmark.functions.time import since
from trailmark.sources import staging

COLUMNS = ["user_id", "session_id", "event_time", "week", "source", "medium", "campaign"]


def classified_context(source_properties: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """(event_id, source, medium, campaign) of staged context rows."""
    signals = {n: F.col(n) for n in traffic.CAMPAIGN_PARAMS}
    referrer = F.col("referrer_host")
    return source_properties.withColumns(traffic.campaign_params(F.col("full_url"))).select(
        "event_id",
        traffic.traffic_source(signals, referrer, cfg.strict_reference).alias("source"),
        traffic.traffic_medium(signals, referrer).alias("medium"),
        traffic.traffic_campaign(signals).alias("campaign"),
    )


def classified_events(
    events: DataFrame, source_properties: DataFrame, cfg: AttributionConfig
) -> DataFrame:
    """Staged events inside the touchpoint lookback with their source, medium and campaign.

    Context rows are classified before the join, so URLs stay out of the shuffle and only the
    three short labels travel.
    """
    horizon = cfg.lookback_days + cfg.attribution_window_days
    recent = lambda t: since(t, cfg.now(), horizon)
    ev = staging.stage_events(events).filter(recent(F.col("event_time")))
    sp = staging.same_event_time(staging.stage_source_properties(source_properties), recent)
    labels = classified_context(sp, cfg)
    return ev.select("event_id", "device_id", "session_id", "event_time").join(labels, "event_id")


def with_identity(df: DataFrame, users: DataFrame) -> DataFrame:
    """``user_id``: the permanent id where the device has one, else the device."""
    known = staging.stage_users(users).withColumnRenamed("user_id", "_uid")
    return df.join(known, "device_id", "left").withColumn("user_id", F.coalesce("_uid", "device_id")).drop("_uid")


def device_touchpoints(
    events: DataFrame, source_properties: DataFrame, cfg: AttributionConfig
) -> DataFrame:
    """(session_id, device_id, best): each session's best signal per device.

    ``best`` is the smallest (rank, time, event) struct, so partial results of any split of the
    events combine with another ``min``.
    """
    best = F.struct(
        traffic.signal_rank(F.col("medium")).alias("rank"), "event_time", "event_id",
        "source", "medium", "campaign",
    )
    rows = classified_events(events, source_properties, cfg).select("session_id", "device_id", best.alias("best"))
    return rows.groupBy("session_id", "device_id").agg(F.min("best").alias("best"))


def identity_touchpoints(per_device: DataFrame, users: DataFrame) -> DataFrame:
    """Touchpoints from per-device bests: devices of one identity may share a session."""
    best = with_identity(per_device, users).groupBy("session_id", "user_id").agg(F.min("best").alias("best"))
    return best.select(
        "user_id", "session_id", "best.event_time",
        F.date_trunc("week", "best.event_time").alias("week"),
        "best.source", "best.medium", "best.campaign",
    )


def touchpoints(
    events: DataFrame, source_properties: DataFrame, users: DataFrame, cfg: AttributionConfig
) -> DataFrame:
    """One row per (session, identity): strongest signal class, then earliest.

    The best signal is taken per device first, so the identity join sees one row per session
    instead of every event.
    """
    return identity_touchpoints(device_touchpoints(events, source_properties, cfg), users)
