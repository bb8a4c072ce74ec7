"""Reusable behaviour analyses over the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.config import work_table
from trailmark.functions.combine import beside, union_all
from trailmark.functions.numbers import ratio
from trailmark.functions.time import DEFAULT_PERIOD, Period, period
from trailmark.operators.ordered import with_order
from trailmark.plans.metrics import (
    FACTS, WEB_VITAL_THRESHOLDS, Condition, Metric, base_rows, metric, metric_query, satisfies, top,
)

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Analysis:
    """Tables plus the moment, time zone and default period that questions refer to."""

    tables: Tables
    as_of: str
    tz: str = "UTC"
    default_period: str = DEFAULT_PERIOD

    def span(self, name: str | Period | None = None) -> Period:
        if isinstance(name, Period):
            return name
        return period(name or self.default_period, self.as_of, self.tz)

    def local_day(self, offset: int = 0) -> str:
        """The local calendar day of ``as_of``, or one some days off."""
        moment = datetime.fromisoformat(self.as_of).replace(tzinfo=UTC).astimezone(ZoneInfo(self.tz))
        return (moment.date() + timedelta(days=offset)).isoformat()

    def rows(self, base: str, dims: Mapping[str, str] | None = None, when: str | Period | None = None) -> DataFrame:
        return base_rows(self.tables, base, dims or {}, self.span(when), self.tz)

    # -- totals, breakdowns, trends -------------------------------------------------------

    def metrics(
        self, names: Sequence[str | Metric], by: Sequence[str] | Mapping[str, str] = (),
        where: Mapping[str, Condition] | None = None, when: str | Period | None = None,
        order_by: str | None = None, descending: bool = True, limit: int | None = None,
    ) -> DataFrame:
        """Totals (no ``by``), breakdowns, top-N (``order_by`` and ``limit``) and trends (a time
        grain in ``by``)."""
        return metric_query(self.tables, names, by, where, self.span(when), self.tz, order_by, descending, limit)

    def trend(self, names: Sequence[str | Metric], grain: str = "day", when: str | Period | None = None) -> DataFrame:
        return self.metrics(names, {"bucket": grain}, when=when)

    def having(
        self, names: Sequence[str | Metric], by: Sequence[str] | Mapping[str, str], keep: Column,
        when: str | Period | None = None,
    ) -> DataFrame:
        """Groups whose metrics satisfy ``keep``."""
        return self.metrics(names, by, when=when).filter(keep)

    def share(
        self, base: str, condition: Column, by: Mapping[str, str] | None = None,
        when: str | Period | None = None, value: Column | None = None,
    ) -> DataFrame:
        """Rows, rows meeting a condition, and their ratio.  ``value`` limits the base to rows that
        have one."""
        rows = self.rows(base, by, when)
        if value is not None:
            rows = rows.filter(value.isNotNull())
        return rows.groupBy(*(by or {})).agg(
            F.count(F.lit(1)).alias("total"), F.count_if(condition).alias("matching"),
            ratio(F.count_if(condition), F.count(F.lit(1))).alias("share"),
        )

    def vital_ratings(self, vitals: Sequence[str] = ("lcp", "cls score", "inp"), when: str | Period | None = None) -> DataFrame:
        """Readings, good readings and poor readings per web vital.  Without a poor limit, anything
        not good is poor."""
        parts = []
        for vital in vitals:
            base, column = FACTS[vital]
            good, poor = WEB_VITAL_THRESHOLDS[vital]
            value = F.col(column)
            bad = value >= good if poor is None else value > poor
            parts.append(self.rows(base, when=when).filter(value.isNotNull()).agg(
                F.count(F.lit(1)).alias("readings"), F.count_if(value < good).alias("good"),
                F.count_if(bad).alias("poor")).withColumn("vital", F.lit(vital)))
        return union_all(parts).withColumn("good_share", ratio(F.col("good"), F.col("readings")))

    def ratio_of(
        self, part: str | Metric, whole: str | Metric, by: Sequence[str] | Mapping[str, str] = (),
        where: Mapping[str, Condition] | None = None, when: str | Period | None = None, name: str = "rate",
    ) -> DataFrame:
        """Two metrics and their quotient; a group with no part counts as zero part."""
        a, b = metric(part), metric(whole)
        out = self.metrics([a, b], by, where, when)
        part_or_zero = F.when(F.col(b.name).isNotNull(), F.coalesce(F.col(a.name), F.lit(0)))
        return out.withColumn(name, ratio(part_or_zero, F.col(b.name)))

    def compare(
        self, names: Sequence[str | Metric], segment: str, values: Sequence[str],
        when: str | Period | None = None,
    ) -> DataFrame:
        """Metrics for chosen values of one dimension."""
        return self.metrics(names, {"segment": segment}, {segment: list(values)}, when)

    def side_by_side(
        self, name: str | Metric, segment: str, left: str, right: str,
        by: Sequence[str] | Mapping[str, str] = (), when: str | Period | None = None,
    ) -> DataFrame:
        """One metric for two values of a dimension as columns, with the difference."""
        m = metric(name)
        dims = dict(by) if isinstance(by, Mapping) else {b: b for b in by}
        flat = self.metrics([m], {**dims, "segment": segment}, {segment: [left, right]}, when)
        wide = flat.groupBy(*dims).pivot("segment", [left, right]).agg(F.first(m.name))
        named = wide.withColumnsRenamed({left: "left_value", right: "right_value"})
        return named.withColumn("difference", F.col("left_value") - F.col("right_value"))

    # -- change over time -------------------------------------------------------------------

    def period_over_period(
        self, names: Sequence[str | Metric], grain: str = "week",
        by: Sequence[str] | Mapping[str, str] = (), when: str | Period | None = "all",
    ) -> DataFrame:
        """Metrics per calendar bucket with the previous bucket's value, the change and its ratio."""
        dims = dict(by) if isinstance(by, Mapping) else {b: b for b in by}
        buckets = self.metrics(names, {**dims, "bucket": grain}, when=when)
        return with_change(buckets, [metric(n).name for n in names], list(dims))

    def window_versus_previous(self, names: Sequence[str | Metric], n_days: int = 7) -> DataFrame:
        """The last ``n_days`` against the ``n_days`` before them, one row per window."""
        now = F.lit(self.as_of).cast("timestamp")
        span = lambda k: F.make_dt_interval(F.lit(k * n_days))
        both = [
            self.metrics(names, when=Period(now - span(1), now)).withColumn("window", F.lit("current")),
            self.metrics(names, when=Period(now - span(2), now - span(1))).withColumn("window", F.lit("previous")),
        ]
        return both[0].unionByName(both[1])

    def day_versus_rest(self, names: Sequence[str | Metric], day: str, when: str | Period | None = "all") -> DataFrame:
        """One named day beside the average of the other days."""
        daily = self.trend(names, "day", when)
        cols = [metric(n).name for n in names]
        is_day = F.date_format("bucket", "yyyy-MM-dd") == day
        return daily.agg(
            *[F.max(F.when(is_day, F.col(c))).alias(f"{c}_day") for c in cols],
            *[F.avg(F.when(~is_day, F.col(c))).alias(f"{c}_other_days") for c in cols],
        )

    def growth(self, grain: str = "week", when: str | Period | None = "past 3 months") -> DataFrame:
        """New users by first activity and the running total."""
        first = self.rows("events", when=when).groupBy("user_id").agg(F.min("event_time").alias("first"))
        new = first.groupBy(F.date_trunc(grain, "first").alias("bucket")).agg(F.count(F.lit(1)).alias("new_users"))
        # One row per bucket from here on.
        running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return new.withColumn("total_users", F.sum("new_users").over(running))

    def time_profile(self, names: Sequence[str | Metric], grain: str, when: str | Period | None = None) -> DataFrame:
        """Metrics by ``weekday`` (1 = Sunday) or ``hour_of_day`` in local time."""
        return self.metrics(names, {grain: grain}, when=when)

    # -- sessions ---------------------------------------------------------------------------

    def session_measures(self, when: str | Period | None = None) -> DataFrame:
        """Duration, events and page views per session.

        The two tables are reduced to sessions before they meet.
        """
        spans = self.rows("events", when=when).groupBy("session_id").agg(
            F.min("event_time").alias("started"), F.max("event_time").alias("ended"),
            F.count(F.lit(1)).alias("events"),
        )
        views = self.rows("page_views", when=when).groupBy("session_id").agg(F.count(F.lit(1)).alias("page_views"))
        seconds = (F.unix_micros("ended") - F.unix_micros("started")) / F.lit(1e6)
        return spans.join(views, "session_id", "left").select(
            "session_id", seconds.alias("duration_seconds"), "events",
            F.coalesce("page_views", F.lit(0)).alias("page_views"),
        )

    def session_averages(self, when: str | Period | None = None) -> DataFrame:
        return self.session_measures(when).agg(
            F.count(F.lit(1)).alias("sessions"), F.avg("duration_seconds").alias("avg_duration_seconds"),
            F.avg("events").alias("avg_events"), F.avg("page_views").alias("avg_page_views"),
        )

    def _viewed_pages(self, when: str | Period | None) -> DataFrame:
        return self.rows("page_views", {"page": "page"}, when).select("session_id", "user_id", "event_id", "event_time", "page")

    def page_edges(self, when: str | Period | None = None) -> DataFrame:
        """First and last viewed page of each session, found without sorting the session."""
        at = F.struct("event_time", "event_id")
        return self._viewed_pages(when).groupBy("session_id").agg(
            F.min_by(F.struct("page"), at)["page"].alias("entry_page"),
            F.max_by(F.struct("page"), at)["page"].alias("exit_page"),
        )

    def entry_pages(self, when: str | Period | None = None) -> DataFrame:
        return self.page_edges(when).groupBy(F.col("entry_page").alias("page")).agg(
            F.count(F.lit(1)).alias("entries"))

    def exit_rates(self, when: str | Period | None = None) -> DataFrame:
        """Exits over views per page."""
        exits = self.page_edges(when).groupBy(F.col("exit_page").alias("page")).agg(F.count(F.lit(1)).alias("exits"))
        views = self.metrics(["page_view_count"], {"page": "page"}, when=when)
        joined = views.join(exits, views["page"].eqNullSafe(exits["page"]), "left").select(
            views["page"], F.col("page_view_count").alias("views"), F.coalesce("exits", F.lit(0)).alias("exits"))
        return joined.withColumn("exit_rate", ratio(F.col("exits"), F.col("views")))

    def next_pages(self, page: str, when: str | Period | None = None) -> DataFrame:
        """Pages viewed right after ``page`` in the same session (NULL: the session ended)."""
        views = work_table(self._viewed_pages(when), "views")
        after = with_order(views, ["session_id"], "event_time", ["event_id"], following={"next_page": "page"})
        return after.filter(F.col("page") == page).groupBy("next_page").agg(F.count(F.lit(1)).alias("moves"))

    # -- frustration and combined signals ----------------------------------------------------

    def frustration(self, by: Mapping[str, str], when: str | Period | None = None) -> DataFrame:
        """Rage clicks + dead clicks + mouse thrashes per group.

        Rows are reduced to narrow (group, score) pairs and summed map-side; they never meet in a join.
        """
        clicks = self.rows("clicks", by, when).select(
            *by, F.col("fs_rage_count").alias("rage"), F.col("fs_dead_count").alias("dead"), F.lit(0).alias("thrash"))
        thrash = self.rows("mouse_thrashes", by, when).select(
            *by, F.lit(0).alias("rage"), F.lit(0).alias("dead"), F.lit(1).alias("thrash"))
        sums = [F.sum(c).alias(c) for c in ("rage", "dead", "thrash")]
        return clicks.unionByName(thrash).groupBy(*by).agg(*sums).withColumn(
            "score", F.col("rage") + F.col("dead") + F.col("thrash"))

    def users_with(
        self, base: str, conditions: Mapping[str, Condition] | None = None, when: str | Period | None = None
    ) -> DataFrame:
        """Distinct users having a row in ``base`` that meets the conditions."""
        dims = {f"_c{i}": name for i, name in enumerate(conditions or {})}
        rows = self.rows(base, dims, when)
        for label, wanted in zip(dims, (conditions or {}).values()):
            rows = rows.filter(satisfies(F.col(label), wanted))
        return rows.select("user_id").distinct()

    def adoption(
        self, base: str, conditions: Mapping[str, Condition] | None = None, when: str | Period | None = None
    ) -> DataFrame:
        """Users who did something, all active users, and the share."""
        did = self.users_with(base, conditions, when).agg(F.count(F.lit(1)).alias("users"))
        everyone = self.rows("events", when=when).agg(F.countDistinct("user_id").alias("active_users"))
        return beside([did, everyone]).withColumn("share", ratio(F.col("users"), F.col("active_users")))

    def frustrated_with_errors(self, pages: Sequence[str], when: str | Period | None = None) -> DataFrame:
        """Users frustrated on the given pages who also met an exception there."""
        by = {"user_id": "user_id", "page": "page"}
        upset = self.frustration(by, when).filter(F.col("page").isin(list(pages)) & (F.col("score") > 0))
        errors = self.metrics(["exception_event_count"], by, {"page": list(pages)}, when)
        return upset.join(errors, ["user_id", "page"]).groupBy("user_id").agg(
            F.sum("score").alias("score"), F.sum("exception_event_count").alias("errors"))

    def correlation(
        self, x: str | Metric, y: str | Metric, by: Sequence[str] | Mapping[str, str], when: str | Period | None = None
    ) -> DataFrame:
        """Pearson correlation of two metrics over the groups of ``by``; a missing count is zero."""
        a, b = metric(x), metric(y)
        grid = self.metrics([a, b], by, when=when).filter(F.col(a.name).isNotNull())
        return grid.agg(
            F.corr(F.col(a.name).cast("double"), F.coalesce(F.col(b.name), F.lit(0)).cast("double")).alias("correlation"),
            F.count(F.lit(1)).alias("groups"),
        )

    def anomalies(
        self, name: str | Metric, grain: str = "day", history: int = 7,
        by: Sequence[str] | Mapping[str, str] = (), where: Mapping[str, Condition] | None = None,
        when: str | Period | None = "all",
    ) -> DataFrame:
        """Each bucket against the mean and deviation of the ``history`` buckets before it."""
        dims = dict(by) if isinstance(by, Mapping) else {b: b for b in by}
        m = metric(name)
        series = self.metrics([m], {**dims, "bucket": grain}, where, when)
        return with_z_score(series, m.name, list(dims), history)


def with_change(buckets: DataFrame, measures: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Previous bucket, change and relative change per measure.  One row per group and bucket in."""
    w = Window.partitionBy(*by).orderBy("bucket")
    prev = buckets.withColumns({f"{c}_previous": F.lag(c).over(w) for c in measures})
    return prev.withColumns({
        **{f"{c}_change": F.col(c) - F.col(f"{c}_previous") for c in measures},
        **{f"{c}_change_ratio": ratio(F.col(c) - F.col(f"{c}_previous"), F.col(f"{c}_previous")) for c in measures},
    })


def with_z_score(series: DataFrame, measure: str, by: Sequence[str], history: int) -> DataFrame:
    """z-score and ratio to the trailing mean.  One row per group and bucket in."""
    w = Window.partitionBy(*by).orderBy("bucket").rowsBetween(-history, -1)
    value = F.col(measure).cast("double")
    return (
        series.withColumns({"trailing_mean": F.avg(value).over(w), "trailing_stddev": F.stddev_samp(value).over(w)})
        .withColumn("z_score", F.try_divide(value - F.col("trailing_mean"), F.nullif(F.col("trailing_stddev"), F.lit(0.0))))
        .withColumn("ratio_to_mean", F.try_divide(value, F.nullif(F.col("trailing_mean"), F.lit(0.0))))
    )
