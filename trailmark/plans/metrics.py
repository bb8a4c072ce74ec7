"""Metric definitions and the query that evaluates them over the star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.config import work_table
from trailmark.functions.combine import beside
from trailmark.functions.time import Period, local_time
from trailmark.operators.quantiles import exact_percentiles
from trailmark.plans.model import TABLES, find_column, route


@dataclass(frozen=True)
class Metric:
    name: str
    base: str
    sql: str
    synonyms: tuple[str, ...] = ()
    # Column and fraction of an exact percentile, which is found by rank selection instead of ``sql``.
    percentile: tuple[str, float] | None = None


def _m(base: str, name: str, sql: str, *synonyms: str) -> Metric:
    return Metric(name, base, sql, synonyms)


def _p(base: str, name: str, column: str, fraction: float) -> Metric:
    return Metric(name, base, f"percentile({column}, {fraction})", percentile=(column, fraction))


# Metric names, definitions and the names users call them by.
METRICS: tuple[Metric, ...] = (
    _m("events", "event_count", "count(id)", "number of events", "total events", "event volume"),
    _m("clicks", "click_count", "count(event_id)", "number of clicks", "total clicks"),
    _m("clicks", "rage_click_count", "sum(fs_rage_count)", "frustrated clicks", "total rage clicks"),
    _m("clicks", "dead_click_count", "sum(fs_dead_count)", "unresponsive clicks", "total dead clicks"),
    _m("clicks", "long_click_count", "count_if(is_click_long)", "long press count"),
    _m("clicks", "unhandled_click_count", "count_if(is_click_unhandled)", "no-handler clicks"),
    _m("page_views", "page_view_count", "count(event_id)", "pvs", "total page views", "number of page views"),
    _m("page_views", "avg_time_on_page", "avg(duration_millis)"),
    _m("page_views", "avg_active_time_on_page", "avg(active_duration_millis)", "average engagement time",
       "avg active time"),
    _m("page_views", "avg_scroll_depth", "avg(max_scroll_depth)"),
    _m("loads", "avg_lcp", "avg(largest_paint_time_millis)", "average largest contentful paint", "average lcp"),
    _m("loads", "avg_fcp", "avg(first_paint_time_millis)", "average first contentful paint", "average fcp"),
    _m("loads", "avg_ttfb", "avg(time_to_first_byte_millis)", "average time to first byte", "average ttfb"),
    _m("loads", "avg_tti", "avg(time_to_interactive_millis)", "average time to interactive", "average tti"),
    _m("loads", "avg_tbt", "avg(total_blocking_time_millis)", "average total blocking time", "average tbt"),
    _m("loads", "avg_dom_content_time", "avg(dom_content_time_millis)", "average dom ready time"),
    _m("loads", "avg_load_time", "avg(load_time_millis)", "average page load time"),
    _m("loads", "load_event_count", "count(event_id)"),
    _m("cumulative_layout_shifts", "avg_cls", "avg(cumulative_layout_shift)", "average cls",
       "average cumulative layout shift"),
    _m("cumulative_layout_shifts", "max_cls", "max(cumulative_layout_shift)", "worst cls", "maximum cls"),
    _m("first_input_delays", "avg_fid", "avg(first_input_delay_millis)", "average first input delay", "average fid"),
    _m("interaction_to_next_paints", "avg_inp", "avg(interaction_to_next_paint_millis)", "average inp",
       "average interaction to next paint", "average responsiveness"),
    _m("interaction_to_next_paints", "max_inp", "max(interaction_to_next_paint_millis)", "worst inp", "maximum inp"),
    _m("interaction_to_next_paints", "inp_event_count", "count(event_id)"),
    _m("interaction_to_next_paints", "poor_inp_count", "count_if(interaction_to_next_paint_millis > 500)",
       "slow interactions", "poor responsiveness count"),
    _p("interaction_to_next_paints", "p75_inp", "interaction_to_next_paint_millis", 0.75),
    _m("mouse_thrashes", "mouse_thrash_count", "count(event_id)", "thrash count", "total mouse thrashes",
       "erratic mouse events"),
    _m("form_abandons", "form_abandon_count", "count(event_id)", "abandonments", "total form abandons",
       "form dropout count"),
    _m("form_input_changes", "form_input_count", "count(event_id)", "total form inputs", "form interaction count"),
    _m("exceptions", "exception_event_count", "count(event_id)"),
    _m("exceptions", "total_exception_occurrences", "sum(exception_count)", "total errors thrown", "total exceptions"),
    _m("exceptions", "unhandled_exception_count", "count_if(not is_exception_handled)", "crashes",
       "uncaught exceptions", "unhandled errors"),
    _m("console_messages", "console_message_count", "count(event_id)", "total console messages", "console log count"),
    _m("crashes", "crash_count", "count(event_id)", "total crashes", "app crash count", "mobile crashes"),
    _m("requests", "client_error_count", "count_if(startswith(request_status, '4'))", "4xx errors", "client errors"),
    _m("requests", "server_error_count", "count_if(startswith(request_status, '5'))", "5xx errors", "server errors"),
    _m("requests", "total_failed_requests", "count(event_id)", "error count", "failed request count",
       "total api errors"),
    _m("navigates", "navigate_count", "count(event_id)", "total navigations", "navigation count"),
    _m("navigates", "reload_count", "count_if(navigate_reason = 'reload')", "page reloads", "total reloads"),
    _m("navigates", "back_forward_count", "count_if(navigate_reason = 'back_forward')", "back button count",
       "browser back count"),
    _m("elements_seen", "element_seen_count", "count(event_id)", "total elements seen", "watched element views"),
    _m("elements_seen", "avg_element_render_duration", "avg(element_render_duration_millis)", "average render time"),
    _m("elements_seen", "avg_element_visible_duration", "avg(element_visible_duration_millis)",
       "average visibility duration"),
    _m("custom_events", "custom_event_count", "count(event_id)", "total custom events", "conversion event count"),
    _m("source_properties", "desktop_event_count", "count_if(user_agent_device = 'Desktop')"),
    _m("source_properties", "mobile_event_count", "count_if(user_agent_device in ('Mobile', 'Tablet'))"),
    _m("users", "user_count", "count(id)", "total users", "visitor count", "unique users"),
    _m("users", "identified_user_count", "count(uid)", "logged in users", "identified users", "known users"),
    _m("pastes", "paste_count", "count(event_id)", "total pastes", "clipboard paste count"),
    _m("consents", "consent_given_count", "count_if(is_consent_given)", "consents granted", "accepted consents"),
    _m("consents", "consent_denied_count", "count_if(not is_consent_given)", "consents denied", "rejected consents"),
    _m("element_properties", "property_update_count", "count(event_id)"),
    _m("page_properties", "page_property_update_count", "count(event_id)"),
    _m("user_properties", "user_property_count", "count(user_id)"),
)

# Counts of the two tables that have dimensions but no declared metric.
EXTRA_METRICS: tuple[Metric, ...] = (
    _m("copies", "copy_count", "count(event_id)"),
    _m("highlights", "highlight_count", "count(event_id)"),
)

# Numeric columns open to ad-hoc aggregates, with their short names.
FACTS: dict[str, tuple[str, str]] = {
    "active time": ("page_views", "active_duration_millis"),
    "engagement time": ("page_views", "active_duration_millis"),
    "idle time": ("page_views", "inactive_duration_millis"),
    "inactive time": ("page_views", "inactive_duration_millis"),
    "time on page": ("page_views", "duration_millis"),
    "total page time": ("page_views", "duration_millis"),
    "scroll depth": ("page_views", "max_scroll_depth"),
    "scroll percentage": ("page_views", "max_scroll_depth"),
    "fcp": ("loads", "first_paint_time_millis"),
    "first contentful paint": ("loads", "first_paint_time_millis"),
    "lcp": ("loads", "largest_paint_time_millis"),
    "largest contentful paint": ("loads", "largest_paint_time_millis"),
    "ttfb": ("loads", "time_to_first_byte_millis"),
    "server response time": ("loads", "time_to_first_byte_millis"),
    "page load time": ("loads", "load_time_millis"),
    "full load time": ("loads", "load_time_millis"),
    "dom ready": ("loads", "dom_content_time_millis"),
    "dom content loaded": ("loads", "dom_content_time_millis"),
    "tti": ("loads", "time_to_interactive_millis"),
    "time to interactive": ("loads", "time_to_interactive_millis"),
    "tbt": ("loads", "total_blocking_time_millis"),
    "blocking time": ("loads", "total_blocking_time_millis"),
    "cls score": ("cumulative_layout_shifts", "cumulative_layout_shift"),
    "layout shift score": ("cumulative_layout_shifts", "cumulative_layout_shift"),
    "visual stability": ("cumulative_layout_shifts", "cumulative_layout_shift"),
    "fid": ("first_input_delays", "first_input_delay_millis"),
    "first input delay": ("first_input_delays", "first_input_delay_millis"),
    "inp": ("interaction_to_next_paints", "interaction_to_next_paint_millis"),
    "interaction to next paint": ("interaction_to_next_paints", "interaction_to_next_paint_millis"),
    "responsiveness": ("interaction_to_next_paints", "interaction_to_next_paint_millis"),
    "render time": ("elements_seen", "element_render_duration_millis"),
    "time to render": ("elements_seen", "element_render_duration_millis"),
    "visibility duration": ("elements_seen", "element_visible_duration_millis"),
    "time visible": ("elements_seen", "element_visible_duration_millis"),
}

# Good below / poor above, in milliseconds (CLS has no unit).
WEB_VITAL_THRESHOLDS: dict[str, tuple[float, float | None]] = {
    "lcp": (2500, None), "fcp": (1800, None), "ttfb": (800, None), "tti": (3800, None),
    "tbt": (200, None), "cls score": (0.1, 0.25), "fid": (100, None), "inp": (200, 500),
}


def distinct_count(name: str, base: str, column: str, approximate: bool = False) -> Metric:
    """Distinct values of a column; the estimate keeps a fixed-size sketch per group."""
    return Metric(name, base, f"approx_count_distinct({column})" if approximate else f"count(distinct {column})")


# Distinct counts of the event table's own keys.
SESSIONS = distinct_count("sessions", "events", "session_id")
VISITORS = distinct_count("visitors", "events", "user_id")

_BY_NAME: dict[str, Metric] = {}
for _metric in (*METRICS, *EXTRA_METRICS):
    _BY_NAME[_metric.name] = _metric
for _metric in METRICS:
    for _alias in _metric.synonyms:
        _BY_NAME.setdefault(_alias, _metric)


def metric(name: str | Metric) -> Metric:
    if isinstance(name, Metric):
        return name
    found = _BY_NAME.get(name) or _BY_NAME.get(name.strip().lower())
    if found is None:
        raise KeyError(f"unknown metric {name!r}")
    return found


def fact_aggregate(name: str, fact: str, sql_function: str) -> Metric:
    """Ad-hoc metric over a declared numeric column, by its name or column, e.g. ``fact_aggregate("p90", "lcp", "percentile({}, 0.9)")``."""
    by_column = {column: (base, column) for base, column in FACTS.values()}
    base, column = FACTS.get(fact) or by_column[fact]
    return Metric(name, base, sql_function.format(column))


def fact_percentile(name: str, fact: str, fraction: float) -> Metric:
    """Exact percentile of a declared numeric column, however large a group is."""
    column = fact_aggregate(name, fact, "{}")
    return _p(column.base, name, column.sql, fraction)


TIME_GRAINS: dict[str, Callable[[Column], Column]] = {
    "minute": lambda t: F.date_trunc("minute", t),
    "hour": lambda t: F.date_trunc("hour", t),
    "day": lambda t: F.date_trunc("day", t),
    "week": lambda t: F.date_trunc("week", t),
    "month": lambda t: F.date_trunc("month", t),
    "hour_of_day": F.hour,
    "weekday": F.dayofweek,
    "is_weekend": lambda t: F.dayofweek(t).isin(1, 7),
}

Condition = Any


def satisfies(col: Column, wanted: Condition) -> Column:
    """A value, a list of values, None for missing, or a function of the column."""
    if callable(wanted):
        return wanted(col)
    if isinstance(wanted, (list, tuple, set)):
        return col.isin(list(wanted))
    return col.isNull() if wanted is None else col == wanted


def base_rows(
    tables: Mapping[str, DataFrame], base: str, dims: Mapping[str, str],
    period: Period | None = None, tz: str = "UTC",
) -> DataFrame:
    """Rows of ``base`` in the period with the requested dimensions attached under their labels.

    ``dims`` maps labels to dimension names or time grains.  Every join is many-to-one and left,
    so base rows never multiply.  The period also filters joined event tables, whose rows carry the
    same event's time; only the key and the needed columns of a joined table are read.
    """
    spec = TABLES[base]
    rows = tables[base]
    bounded = period is not None and (period.start is not None or period.end is not None)
    if bounded and spec.time:
        rows = rows.filter(period.holds(F.col(spec.time)))
    elif bounded and base in ("users", "user_properties"):
        # People have no time of their own: those with an event in the period count.
        events = tables["events"]
        active = events.filter(period.holds(F.col(TABLES["events"].time))).select(F.col("user_id").alias(spec.key)).distinct()
        rows = rows.join(active, spec.key, "left_semi")
    grains = {k: v for k, v in dims.items() if v in TIME_GRAINS}
    columns = {k: find_column(tables, base, v) for k, v in dims.items() if v not in TIME_GRAINS}
    if grains:
        if not spec.time:
            raise ValueError(f"{base} has no event time")
        moment = local_time(F.col(spec.time), tz) if tz != "UTC" else F.col(spec.time)
        rows = rows.withColumns({k: TIME_GRAINS[g](moment) for k, g in grains.items()})

    needed: dict[str, dict[str, str]] = {}
    hops = []
    for label, (table, column) in columns.items():
        needed.setdefault(table, {})[label] = column
        for hop in route(base, table):
            if hop not in hops:
                hops.append(hop)
    own = needed.pop(base, {})
    if own:
        rows = rows.withColumns({label: F.col(c) for label, c in own.items()})
    for hop in hops:
        side = tables[hop.target]
        if period is not None and TABLES[hop.target].time:
            side = side.filter(period.holds(F.col(TABLES[hop.target].time)))
        onward = {h.left for h in hops if h.source == hop.target}
        picked = [F.col(hop.right).alias(f"_key_{hop.target}")]
        picked += [F.col(c).alias(f"_via_{hop.target}_{c}") for c in sorted(onward)]
        picked += [F.col(c).alias(label) for label, c in needed.get(hop.target, {}).items()]
        left = hop.left if hop.source == base else f"_via_{hop.source}_{hop.left}"
        rows = rows.join(side.select(*picked), F.col(left) == F.col(f"_key_{hop.target}"), "left")
    return rows


def metric_query(
    tables: Mapping[str, DataFrame],
    metrics: Sequence[str | Metric],
    by: Sequence[str] | Mapping[str, str] = (),
    where: Mapping[str, Condition] | None = None,
    period: Period | None = None,
    tz: str = "UTC",
    order_by: str | None = None,
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Metrics by dimensions.

    Metrics of one base share one scan.  Bases are aggregated separately to the dimension grain
    and only then combined, so no metric is multiplied by another table's rows; a group missing
    from a base has NULL there.  ``where`` and ``period`` apply to every base before aggregation.
    """
    chosen = [metric(m) for m in metrics]
    labels = dict(by) if isinstance(by, Mapping) else {b.replace(" ", "_").replace(".", "_"): b for b in by}
    where = where or {}
    parts = []
    for base in dict.fromkeys(m.base for m in chosen):
        # Prefixed labels cannot collide with a base column the metric reads.
        dims = {f"_by_{label}": name for label, name in labels.items()}
        dims |= {f"_where_{i}": name for i, name in enumerate(where)}
        rows = base_rows(tables, base, dims, period, tz)
        for i, wanted in enumerate(where.values()):
            rows = rows.filter(satisfies(F.col(f"_where_{i}"), wanted))
        mine = [m for m in chosen if m.base == base]
        plain = [F.expr(m.sql).alias(m.name) for m in mine if not m.percentile]
        keys = [f"_by_{x}" for x in labels]
        grouped = [rows.groupBy(*keys).agg(*plain)] if plain else []
        for column in dict.fromkeys(m.percentile[0] for m in mine if m.percentile):
            wanted = {m.name: m.percentile[1] for m in mine if m.percentile and m.percentile[0] == column}
            # Read several times: the joins of the dimensions are done once.
            narrow = work_table(rows.select(*keys, column), "percentile-rows")
            grouped.append(exact_percentiles(narrow, keys, column, wanted))
        parts += [g.withColumnsRenamed({f"_by_{x}": x for x in labels}) for g in grouped]
    out = parts[0] if len(parts) == 1 else beside(parts, list(labels))
    out = out.select(*labels, *[m.name for m in chosen])
    return top(out, order_by, list(labels), descending, limit) if order_by else out


def top(
    df: DataFrame, measure: str, ties: Sequence[str], descending: bool = True, limit: int | None = None
) -> DataFrame:
    """Order by a measure, ties by name, NULLs last; optionally the first ``limit`` rows."""
    first = F.col(measure).desc_nulls_last() if descending else F.col(measure).asc_nulls_last()
    ordered = df.orderBy(first, *[F.col(x).asc_nulls_last() for x in ties])
    return ordered.limit(limit) if limit else ordered
