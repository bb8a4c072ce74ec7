"""Metrics, behaviour templates and the question catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import TZ, Build
from checks.parity import hits
from trailmark.operators import funnel
from trailmark.plans.behavior import Analysis
from trailmark.plans.metrics import EXTRA_METRICS, METRICS, SESSIONS, VISITORS, fact_aggregate, metric_query
from trailmark.plans.questions import questions
from trailmark.sources.landing import Star

NOW = "2024-01-30 18:00:00"


def analysis(t: Star) -> Analysis:
    return Analysis(t, NOW, default_period="past month")


def ask(name: str) -> Build:
    return lambda t: questions(analysis(t))[name]()


QUESTION_NAMES = list(questions(Analysis({}, NOW)))
QUESTIONS = {name: ask(name) for name in QUESTION_NAMES}

# The dimension each base is broken down by: context for event tables, own columns elsewhere.
BASE_DIMENSION = {"users": {"known": "uid"}, "user_properties": {"tier": "loyalty_tier"},
                  "source_properties": {"page": "page"}, "element_properties": {"page": "page"}}


# Facts used ad hoc, by the table that has them.
VIEW_FACTS = ("active_duration_millis", "inactive_duration_millis", "duration_millis", "max_scroll_depth")
LOAD_FACTS = ("first_paint_time_millis", "dom_content_time_millis", "time_to_interactive_millis", "total_blocking_time_millis")
OTHER_FACTS = ("first_input_delay_millis", "element_render_duration_millis", "element_visible_duration_millis")


def _base_metrics() -> dict[str, Build]:
    out = {}
    for base in dict.fromkeys(m.base for m in (*METRICS, *EXTRA_METRICS)):
        names = [m.name for m in (*METRICS, *EXTRA_METRICS) if m.base == base]
        by = BASE_DIMENSION.get(base, {"page": "page"})
        out[f"metric_{base}"] = lambda t, names=names, by=by: analysis(t).metrics(names, by, when="all")
    return out


METRIC_LAYER: dict[str, Build] = {
    **_base_metrics(),
    "k21_metrics_across_bases": lambda t: analysis(t).metrics(
        [SESSIONS, "page_view_count", "rage_click_count", "crash_count", "p75_inp"],
        {"page": "page", "day": "day", "device": "device type"}, where={"country": ["Japan", "Germany"]}),
    "k21_user_count_last_week": lambda t: analysis(t).metrics(["user_count", "identified_user_count"], when="last week"),
    "k21_facts_of_views": lambda t: analysis(t).metrics(
        [fact_aggregate(f"max_{f}", f, "max({})") for f in VIEW_FACTS], {"page": "page"}, when="all"),
    "k21_facts_of_loads": lambda t: analysis(t).metrics(
        [fact_aggregate(f"sum_{f}", f, "sum({})") for f in LOAD_FACTS], {"page": "page"}, when="all"),
    "k21_facts_of_inputs_and_elements": lambda t: analysis(t).metrics(
        [fact_aggregate(f"min_{f}", f, "min({})") for f in OTHER_FACTS], {"page": "page"}, when="all"),
    "k21_metrics_by_synonym": lambda t: metric_query(
        t, ["pvs", "average lcp", "5xx errors"], ["browser", "operating system"]),
    "k21_metrics_by_definitions": lambda t: analysis(t).metrics(
        ["event_count", VISITORS], {"element": "named element", "event": "named event"}),
    "k21_metrics_by_user": lambda t: analysis(t).metrics(
        ["click_count", "exception_event_count"], {"uid": "uid", "tier": "user_properties.loyalty_tier"}),
}

TEMPLATES: dict[str, Build] = {
    "b01_total_in_period": lambda t: analysis(t).metrics(["click_count", "rage_click_count", "crash_count"], when="last week"),
    "b02_top_n_by_dimension": lambda t: analysis(t).metrics(
        ["click_count"], {"city": "city"}, order_by="click_count", limit=7),
    "b03_weekly_trend": lambda t: analysis(t).trend(["avg_inp", "poor_inp_count"], "week", "all"),
    "b04_share_by_segment": lambda t: analysis(t).share(
        "loads", F.col("time_to_first_byte_millis") < 800, {"device": "device type"}),
    "b04_vital_ratings": lambda t: analysis(t).vital_ratings(("lcp", "cls score", "inp", "ttfb"), "all"),
    "b05_side_by_side": lambda t: analysis(t).side_by_side(
        "page_view_count", "device type", "Mobile", "Desktop", {"country": "country"}),
    "b06_change_by_segment": lambda t: analysis(t).period_over_period(["event_count"], "week", {"device": "device type"}),
    "b07_session_averages": lambda t: analysis(t).session_averages("all"),
    "b08_entities_over_threshold": lambda t: analysis(t).having(
        ["event_count", SESSIONS], {"user_id": "user_id"}, F.col("event_count") >= 80, "all"),
    "b09_entry_and_exit_pages": lambda t: analysis(t).page_edges("all"),
    "b10_next_page": lambda t: analysis(t).next_pages("Search", "all"),
    "b11_step_reach": lambda t: funnel.step_session_counts(hits(t)),
    "b12_ratio_of_two_facts": lambda t: analysis(t).ratio_of("dead_click_count", "page_view_count", {"page": "page"}, when="all"),
    "b13_frustration_score": lambda t: analysis(t).frustration({"session_id": "session_id", "user_id": "user_id"}, "all"),
    "b14_signals_together": lambda t: analysis(t).frustrated_with_errors(["ProductPage", "Search", "Checkout Review"], "all"),
    "b15_correlation": lambda t: analysis(t).correlation("event_count", "exception_event_count", {"user_id": "user_id"}, "all"),
    "b16_anomaly_scores": lambda t: analysis(t).anomalies("event_count", "day", 5, {"device": "device type"}),
    "b17_time_profile": lambda t: Analysis(t, NOW, TZ, "past month").time_profile(["event_count", SESSIONS], "hour_of_day"),
    "b18_weekday_weekend": lambda t: analysis(t).metrics([VISITORS, "event_count"], {"is_weekend": "is_weekend"}, when="all"),
    "b19_adoption": lambda t: analysis(t).adoption("clicks", {"page": "Search"}, "all"),
    "b20_growth": lambda t: analysis(t).growth("day", "all"),
}
