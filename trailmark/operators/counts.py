"""Session and user counts that agree with the product UI.

Joins to users and user properties run after events are reduced to distinct keys: the counts
only see distinct values, the shuffle gets small, and a device with very many events turns into
one row before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.time import on_local_day
from trailmark.sources.staging import same_event_time


def pages_of_events(
    source_properties: DataFrame, page_definitions: DataFrame, names: list[str] | None = None
) -> DataFrame:
    """(event_id, page) for events on a defined page.

    Definitions are filtered first and joined to the context rows, so the context side shrinks
    before it meets the event table.  Spark broadcasts the definitions when they are small.
    """
    defs = page_definitions.select(F.col("id").alias("page_definition_id"), F.col("name").alias("page"))
    if names is not None:
        defs = defs.filter(F.col("page").isin(names))
    return source_properties.select("event_id", "page_definition_id").join(
        defs, "page_definition_id"
    ).select("event_id", "page")


def sessions_by_page(
    events: DataFrame, source_properties: DataFrame, page_definitions: DataFrame,
    page: str, day: str, tz: str,
) -> DataFrame:
    """Distinct sessions that visited ``page`` on a local day."""
    on_day = lambda t: on_local_day(t, day, tz)
    pages = pages_of_events(same_event_time(source_properties, on_day), page_definitions, [page])
    hits = events.filter(on_day(F.col("event_time"))).select(F.col("id").alias("event_id"), "session_id")
    return hits.join(pages, "event_id").agg(F.countDistinct("session_id").alias("sessions"))


def device_and_identified_counts(events: DataFrame, users: DataFrame, day: str, tz: str) -> DataFrame:
    """Distinct devices and distinct uids among the day's events whose device has a user row."""
    devices = events.filter(on_local_day(F.col("event_time"), day, tz)).select("user_id").distinct()
    return devices.join(users.select(F.col("id").alias("user_id"), "uid"), "user_id").agg(
        F.countDistinct("user_id").alias("cnt_user_id"), F.countDistinct("uid").alias("cnt_uid")
    )


def ui_user_count(events: DataFrame, users: DataFrame, day: str, tz: str) -> DataFrame:
    """One identity per session (largest uid, else largest device), counted distinctly."""
    seen = (
        events.filter(on_local_day(F.col("event_time"), day, tz))
        .select("session_id", "user_id").distinct()
    )
    per_session = (
        seen.join(users.select(F.col("id").alias("user_id"), "uid"), "user_id")
        .groupBy("session_id").agg(F.max("user_id").alias("user_id"), F.max("uid").alias("uid"))
    )
    return per_session.agg(F.countDistinct(F.coalesce("uid", "user_id")).alias("cnt_users"))


def property_id_count(
    events: DataFrame, user_properties: DataFrame, prop: str, day: str, tz: str
) -> DataFrame:
    """Distinct values of a custom user property among the day's users."""
    devices = events.filter(on_local_day(F.col("event_time"), day, tz)).select("user_id").distinct()
    known = user_properties.filter(F.col(prop).isNotNull()).select("user_id", prop)
    return devices.join(known, "user_id").agg(F.countDistinct(prop).alias("cnt_property_ids"))
