"""Single operators not already visible in a larger query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import DAY, TZ, Build
from checks.jobs import SPLIT
from checks.parity import hits
from trailmark.config import work_path
from trailmark.functions.time import local_time, on_local_day
from trailmark.functions.traffic import url_param
from trailmark.operators import export, funnel, quality
from trailmark.operators.ordered import with_order
from trailmark.sources import staging
from trailmark.sources.landing import Star, export_users


def s01(t: Star) -> DataFrame:
    """Views over templated sources, queried by SQL."""
    names = {"events": "events.parquet", "buyers": "customer.parquet"}
    staging.Tables(t.spark, t.sf_dir + "/{}", names).register("raw_")
    return t.spark.sql("""
        SELECT event_type, count(*) AS events, (SELECT count(*) FROM raw_buyers) AS buyers
        FROM raw_events GROUP BY event_type""")


def s12(t: Star) -> DataFrame:
    """Create a table from a query, append to it, read it."""
    path = work_path(t.spark, "created")
    t["clicks"].filter(F.col("event_time") < SPLIT).write.parquet(path)
    t["clicks"].filter(F.col("event_time") >= SPLIT).write.mode("append").parquet(path)
    return t.spark.read.parquet(path).select("event_id", "user_id", "event_time", "target_text")


def w01(t: Star) -> DataFrame:
    return with_order(
        t["events"], ["user_id"], "event_time", ["id"], position="rn", size="n",
        previous={"previous_time": "event_time"}, following={"next_type": "event_type"},
    ).select("id", "rn", "n", "previous_time", "next_type")


OPERATORS: dict[str, Build] = {
    "s1_source_views": s01,
    "s12_create_and_append": s12,
    "s16_sampled_users": lambda t: export.exportable(export_users(t.spark, t.sf_dir)).orderBy("uid").limit(50),
    "fx_sessions": lambda t: t.base.select("id", "session_id"),
    "p1_local_day_rows": lambda t: t["events"].filter(on_local_day(F.col("event_time"), DAY, TZ)).select("id"),
    "j10_after_session_mark": lambda t: funnel.after_session_mark(
        hits(t).filter("step = 2"), hits(t).filter("step = 1"), "event_time").select("session_id", "event_time"),
    "w1_w3_w4_user_order": w01,
    "o3_latest_event_per_user": lambda t: t["events"].groupBy("user_id").agg(
        F.max_by("event_type", F.struct("event_time", "id")).alias("event_type"), F.max("event_time").alias("event_time")),
    "p15_unexpected_clicks": lambda t: quality.unexpected(t["clicks"].select("event_id", "fs_rage_count", "fs_dead_count"), [
        {"fs_rage_count": 0, "fs_dead_count": 0}, {"fs_rage_count": 0, "fs_dead_count": 1}]),
    "g11_absent_kinds": lambda t: quality.absent(
        {kind: t["events"].filter(F.col("event_type") == kind) for kind in ("click", "purchase", "refund", "view", "chat")}),
    "u1_funnel_hits": hits,
    "x1_decoded_campaign": lambda t: t["source_properties"].select(
        "event_id", url_param(F.col("url_full_url"), "utm_campaign", decode=True).alias("campaign")),
    "x9_local_calendar": lambda t: t["events"].groupBy(
        F.date_format(local_time(F.col("event_time"), TZ), "yyyy-MM-dd HH").alias("hour")).agg(F.count(F.lit(1)).alias("events")),
}
