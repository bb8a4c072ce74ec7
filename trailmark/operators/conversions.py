"""Conversions with their predecessor per identity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.config import AttributionConfig, work_table
from trailmark.functions.time import since
from trailmark.operators.ordered import with_order
from trailmark.operators.touchpoints import with_identity
from trailmark.sources import staging

COLUMNS = ["user_id", "conversion_session_id", "converted_at", "conversion_revenue",
           "previous_conversion_at", "conversion_index"]


def device_conversions(custom_events: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """The configured event inside the lookback, per device, with its price."""
    raw = custom_events.filter(F.col("event_name") == cfg.conversion_event_name).filter(
        since(F.col("event_time"), cfg.now(), cfg.lookback_days)
    )
    return staging.stage_custom_events(raw, cfg).select(
        "device_id", F.col("session_id").alias("conversion_session_id"),
        F.col("event_time").alias("converted_at"), F.col("price").alias("conversion_revenue"), "event_id",
    )


def conversions(custom_events: DataFrame, users: DataFrame, cfg: AttributionConfig) -> DataFrame:
    """Adds the previous conversion's time and a running index per identity.

    Both look only at conversions inside the lookback: the first one there has no predecessor.
    The identified conversions are written once, since ordering reads them twice.
    """
    return ordered_conversions(work_table(with_identity(device_conversions(custom_events, cfg), users), "identified-conversions"))


def ordered_conversions(found: DataFrame) -> DataFrame:
    """``found`` (a scan or ``work_table`` output) with each conversion's predecessor and number per user."""
    return with_order(
        found, ["user_id"], "converted_at", ["event_id"], position="conversion_index",
        previous={"previous_conversion_at": "converted_at"},
    ).select(*COLUMNS)
