"""Ordered session funnels with any number of steps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.config import work_table
from trailmark.functions.combine import union_all
from trailmark.functions.numbers import safe_pct
from trailmark.functions.time import Period, on_local_day
from trailmark.operators.counts import pages_of_events
from trailmark.sources.staging import same_event_time


@dataclass(frozen=True)
class Step:
    """A funnel step: any of some named pages, or a custom event."""

    pages: tuple[str, ...] = ()
    event: str | None = None


# The purchase funnel.
PURCHASE_FUNNEL = (
    Step(pages=("ProductPage", "Search")),
    Step(pages=("Checkout Billing",)),
    Step(pages=("Checkout Payment",)),
    Step(pages=("Checkout Review",)),
    Step(event="Checkout Success"),
)


def _step_numbers(col: Column, wanted: list[tuple[int, tuple[str, ...]]]) -> Column:
    """One row per step that the name belongs to; a name may serve several steps."""
    return F.explode(F.array_compact(F.array(*[F.when(col.isin(list(names)), F.lit(n)) for n, names in wanted])))


def step_hits(
    events: DataFrame, source_properties: DataFrame, page_definitions: DataFrame,
    custom_events: DataFrame, steps: tuple[Step, ...], day: str | None = None, tz: str = "UTC",
    period: Period | None = None,
) -> DataFrame:
    """(user_id, session_id, event_time, step), one row per event and step that it matches.

    A local ``day`` or a ``period`` bounds the scans of events, context and custom events alike.  Page tags and custom-event tags are built from their own narrow tables and unioned, so the
    event table is scanned and joined once.
    """
    page_steps = [(i + 1, s.pages) for i, s in enumerate(steps) if s.pages]
    event_steps = [(i + 1, (s.event,)) for i, s in enumerate(steps) if s.event]
    if day:
        in_range = lambda t: on_local_day(t, day, tz)
    elif period and (period.start is not None or period.end is not None):
        in_range = period.holds
    else:
        in_range = lambda t: t.isNotNull()
    tags = []
    if page_steps:
        names = sorted({p for _, ps in page_steps for p in ps})
        pages = pages_of_events(same_event_time(source_properties, in_range), page_definitions, names)
        tags.append(pages.select("event_id", _step_numbers(F.col("page"), page_steps).alias("step")))
    if event_steps:
        names = sorted({p for _, ps in event_steps for p in ps})
        named = same_event_time(custom_events, in_range).filter(F.col("event_name").isin(names))
        tags.append(named.select("event_id", _step_numbers(F.col("event_name"), event_steps).alias("step")))
    hits = events.filter(in_range(F.col("event_time"))).select(
        F.col("id").alias("event_id"), "user_id", "session_id", "event_time"
    )
    return hits.join(union_all(tags), "event_id").select("user_id", "session_id", "event_time", "step")


def first_touch_times(hits: DataFrame, n_steps: int) -> DataFrame:
    """Earliest time of each step per (user, session)."""
    return hits.groupBy("user_id", "session_id").agg(
        *[F.min(F.when(F.col("step") == i, F.col("event_time"))).alias(f"stp{i}_time")
          for i in range(1, n_steps + 1)]
    )


def reached(n_steps: int) -> list[Column]:
    """For steps 2..n: every step so far has a time and it is after the one before."""
    flags, so_far = [], F.lit(True)
    for i in range(2, n_steps + 1):
        here, prev = F.col(f"stp{i}_time"), F.col(f"stp{i - 1}_time")
        so_far = so_far & here.isNotNull() & (here > prev)
        flags.append(so_far)
    return flags


def with_rates(counts: DataFrame, n_steps: int) -> DataFrame:
    """Append step-to-step and overall percentages to stpN_sessions columns."""
    s = lambda i: F.col(f"stp{i}_sessions")
    rates = [safe_pct(s(i), s(i - 1)).alias(f"stp{i - 1}_to_stp{i}_pct") for i in range(2, n_steps + 1)]
    return counts.select("*", *rates, safe_pct(s(n_steps), s(1)).alias("overall_pct"))


def first_touch_funnel(hits: DataFrame, n_steps: int) -> DataFrame:
    """One aggregation per session on first times; a step counts when all steps are in order.

    Step 1 counts distinct session ids, later steps count (user, session) pairs.
    """
    entered = first_touch_times(hits, n_steps).filter(F.col("stp1_time").isNotNull())
    counts = entered.agg(
        F.countDistinct("session_id").alias("stp1_sessions"),
        *[F.count_if(flag).alias(f"stp{i}_sessions") for i, flag in enumerate(reached(n_steps), 2)],
    )
    return with_rates(counts, n_steps)


def after_session_mark(rows: DataFrame, marks: DataFrame, at: str) -> DataFrame:
    """Rows later than some mark of their session.

    Equal to a semi join on session and ``mark < event_time``: a row is later than some mark
    exactly if it is later than the earliest, so marks shrink to one row per session first.
    """
    earliest = marks.groupBy("session_id").agg(F.min(at).alias("_after"))
    return rows.join(earliest, "session_id").filter(F.col("event_time") > F.col("_after")).drop("_after")


def chained_funnel(hits: DataFrame, n_steps: int) -> DataFrame:
    """Each step's time is the first one after the session's previous step.

    The tagged events are written once and each step scans only its own.  A session needs only its earliest
    time per step, so one row per session takes up one step after the other, n - 1 joins in all, and a last
    aggregation counts every step.
    """
    hits = work_table(hits.filter(F.col("session_id").isNotNull()).select("session_id", "event_time", "step"), "funnel-hits")
    step = lambda i: hits.filter(F.col("step") == i)
    line = step(1).groupBy("session_id").agg(F.min("event_time").alias("at_1"))
    for i in range(2, n_steps + 1):
        later = F.min(F.when(F.col("event_time") > F.col(f"at_{i - 1}"), F.col("event_time"))).alias(f"at_{i}")
        known = [f"at_{j}" for j in range(1, i)]
        line = line.join(step(i).drop("step"), "session_id", "left").groupBy("session_id", *known).agg(later)
    counts = line.agg(*[F.count(f"at_{i}").alias(f"stp{i}_sessions") for i in range(1, n_steps + 1)])
    return with_rates(counts, n_steps)


def step_session_counts(hits: DataFrame) -> DataFrame:
    """Sessions and users that saw each step at all, in any order."""
    return hits.groupBy("step").agg(
        F.countDistinct("session_id").alias("sessions"), F.countDistinct("user_id").alias("users")
    )


def started_not_finished(hits: DataFrame, n_steps: int) -> DataFrame:
    """Users who entered step 1 and in no session completed the ordered funnel."""
    flags = reached(n_steps)
    per_user = (
        first_touch_times(hits, n_steps).filter(F.col("stp1_time").isNotNull())
        .groupBy("user_id").agg(F.bool_or(flags[-1]).alias("finished"))
    )
    return per_user.agg(F.count_if(~F.col("finished")).alias("users"))
