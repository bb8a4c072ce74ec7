"""Time predicates that reach the Parquet scan, and the period vocabulary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts(value: str | Column) -> Column:
    return F.lit(value).cast("timestamp") if isinstance(value, str) else value


def days(n: int) -> Column:
    return F.make_dt_interval(F.lit(int(n)))


def days_before(moment: Column, n: int) -> Column:
    """``moment - n days`` as a timestamp (not a date)."""
    return moment - days(n)


def on_local_day(col: Column, day: str, tz: str) -> Column:
    """``date(col in tz) = day`` written as a half-open UTC range.

    Wrapping the column in a timezone function would leave only IsNotNull in the scan; the range
    pushes both bounds.  Each end converts on its own, so 23- and 25-hour days are right.
    """
    start = F.to_utc_timestamp(ts(f"{day} 00:00:00"), tz)
    end = F.to_utc_timestamp(ts(f"{day} 00:00:00") + days(1), tz)
    return (col >= start) & (col < end)


def since(col: Column, now: Column, n_days: int) -> Column:
    """Rolling lookback, lower bound included."""
    return col >= days_before(now, n_days)


def local_time(col: Column, tz: str) -> Column:
    return F.from_utc_timestamp(col, tz)


@dataclass(frozen=True)
class Period:
    """A half-open UTC time range; either end may be open."""

    start: Column | None = None
    end: Column | None = None

    def holds(self, col: Column) -> Column:
        cond = F.lit(True)
        if self.start is not None:
            cond = col >= self.start
        if self.end is not None:
            cond = cond & (col < self.end) if self.start is not None else (col < self.end)
        return cond


# The named rolling periods and their length in days.
ROLLING_DAYS = {
    "last 24 hours": 1,
    "last week": 7,
    "last 7 days": 7,
    "past month": 30,
    "last 30 days": 30,
    "past 3 months": 90,
}
DEFAULT_PERIOD = "last week"


def period(name: str, as_of: str, tz: str = "UTC") -> Period:
    """Resolve a period name against ``as_of`` (a UTC timestamp text).

    ``today``, ``this week`` (from Monday) and ``this month`` run from their local beginning to ``as_of``;
    ``yesterday`` is the local day before;
    rolling names count whole days back; ``all`` is unbounded.
    """
    now = ts(as_of)
    midnight = F.to_utc_timestamp(F.date_trunc("day", F.from_utc_timestamp(now, tz)), tz)
    if name == "all":
        return Period()
    if name == "today":
        return Period(midnight, now)
    if name in ("this week", "this month"):
        begin = F.date_trunc(name.split()[1], F.from_utc_timestamp(now, tz))
        return Period(F.to_utc_timestamp(begin, tz), now)
    if name == "yesterday":
        before = F.to_utc_timestamp(F.date_trunc("day", F.from_utc_timestamp(now, tz)) - days(1), tz)
        return Period(before, midnight)
    if name in ROLLING_DAYS:
        return Period(days_before(now, ROLLING_DAYS[name]), now)
    raise ValueError(f"unknown period {name!r}")


def clock_range(day: str, start: str, end: str, tz: str = "UTC") -> Period:
    """A clock range of one local day, such as 14:00 to 16:00."""
    return Period(F.to_utc_timestamp(ts(f"{day} {start}"), tz), F.to_utc_timestamp(ts(f"{day} {end}"), tz))
