"""The catalogue of answerable questions, each a short call into ``Analysis``.

Names start with the question's number in the blueprint; ``role_*`` entries answer the questions
grouped by role.  Site-specific names (events, pages, thresholds) are in ``Site``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.numbers import ratio
from trailmark.functions.time import clock_range
from trailmark.operators import funnel
from trailmark.operators.funnel import PURCHASE_FUNNEL, Step
from trailmark.plans.behavior import Analysis, with_change, with_z_score
from trailmark.plans.metrics import SESSIONS, VISITORS, Metric, fact_percentile, top

PAGE = {"page": "page"}
DEVICE = {"device": "device type"}
ENGAGEMENT = ["page_view_count", "avg_time_on_page", "avg_active_time_on_page", "avg_scroll_depth"]
CORE = [SESSIONS, VISITORS, "event_count", "page_view_count", "click_count", "exception_event_count"]
VITALS = ["avg_lcp", "avg_cls", "avg_inp"]
CHROME_SAFARI = ["Chrome", "Safari"]


@dataclass(frozen=True)
class Site:
    """Names a site configures for itself."""

    home: str = "Home"
    checkout_pages: tuple[str, ...] = ("Checkout Billing", "Checkout Payment", "Checkout Review")
    conversion: str = "Checkout Success"
    signup: str = "Signup"
    survey: str = "NPS Survey"
    experiment: str = "Experiment Viewed"
    banner: str = "banner"
    special_day: str = "2024-01-15"
    high_frustration: int = 3
    spike: float = 2.0  # standard deviations
    search_funnel: tuple[Step, ...] = (Step(pages=("Home",)), Step(pages=("Search",)), Step(event="Checkout Success"))


def events_named(name: str) -> Metric:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return Metric("named_event_count", "custom_events", f"count_if(event_name = '{quoted}')")


def questions(a: Analysis, site: Site = Site()) -> dict[str, Callable[[], DataFrame]]:
    """Question name to a function building its answer."""
    converted, signed_up = events_named(site.conversion), events_named(site.signup)
    status_500 = Metric("status_500_count", "requests", "count_if(request_status = '500')")
    engaged = Metric("engagement_rate", "page_views", "sum(active_duration_millis) / sum(duration_millis)")
    response = Metric("avg_request_duration", "requests", "avg(request_duration_millis)")
    lcp, cls = "largest_paint_time_millis", "cumulative_layout_shift"
    inp = "interaction_to_next_paint_millis"
    conversion_rate = lambda by, when=None: a.ratio_of(converted, SESSIONS, by, when=when)

    def ranked(names, by, limit=None, up=False, when=None, where=None):
        m = names[0] if isinstance(names, list) else names
        label = m if isinstance(m, str) else m.name
        return a.metrics(names if isinstance(names, list) else [names], by, where, when,
                         order_by=label, descending=not up, limit=limit)

    def hits(steps):
        span = a.span()
        return funnel.step_hits(
            a.tables["events"], a.tables["source_properties"], a.tables["page_definitions"], a.tables["custom_events"],
            steps, period=span)

    def busy_sessions(pages: int):
        seen = a.rows("page_views").groupBy("session_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
        return seen.filter(F.col("n") > pages).agg(F.countDistinct("user_id").alias("users"))

    def mobile_share():
        on_mobile = F.when(F.col("device") == "Mobile", F.col("user_id"))
        return a.rows("events", DEVICE).agg(
            F.countDistinct(on_mobile).alias("mobile_users"), F.countDistinct("user_id").alias("all_visitors"),
        ).withColumn("share", ratio(F.col("mobile_users"), F.col("all_visitors")))

    def drop_off():
        counts = funnel.first_touch_funnel(hits(PURCHASE_FUNNEL), len(PURCHASE_FUNNEL))
        return counts.select("stp2_sessions", "stp3_sessions", (
            1 - ratio(F.col("stp3_sessions"), F.col("stp2_sessions"))).alias("drop_off"))

    def rate_change(by=()):
        weekly = conversion_rate({**dict(by), "bucket": "week"}, "all")
        return with_change(weekly, ["rate"], list(dict(by)))

    def mobile_frustrated(score: int):
        by = {"user_id": "user_id", "device": "device type"}
        return a.frustration(by).filter((F.col("device") == "Mobile") & (F.col("score") >= score)).select(
            "user_id", "score")

    def identified_with_errors():
        known = a.tables["users"].filter(F.col("uid").isNotNull()).select(F.col("id").alias("user_id"), "uid")
        errors = a.metrics(["exception_event_count"], {"user_id": "user_id"})
        return errors.join(known, "user_id").groupBy("uid").agg(F.sum("exception_event_count").alias("errors"))

    def scroll_histogram():
        depth = F.least(F.floor(F.col("max_scroll_depth") * 10), F.lit(9)).cast("long")
        return a.rows("page_views").groupBy(depth.alias("tenth")).agg(F.count(F.lit(1)).alias("views"))

    def contribution():
        """Week-over-week change of conversions split by device, with each device's part of it."""
        weekly = a.metrics([converted], {**DEVICE, "bucket": "week"}, when="all")
        change = with_change(weekly, ["named_event_count"], ["device"])
        total = change.groupBy("bucket").agg(F.sum("named_event_count_change").alias("total_change"))
        return change.join(total, "bucket").select(
            "device", "bucket", "named_event_count", "named_event_count_change", "total_change",
            ratio(F.col("named_event_count_change"), F.col("total_change")).alias("part"))

    return {
        "q001_unique_visitors_last_week": lambda: a.metrics([VISITORS], when="last week"),
        "q002_sessions_today": lambda: a.metrics([SESSIONS], when="today"),
        "q003_page_views_yesterday": lambda: a.metrics(["page_view_count"], when="yesterday"),
        "q004_average_session_duration": lambda: a.session_averages().select("avg_duration_seconds"),
        "q005_daily_active_users": lambda: a.trend([VISITORS], "day", "past month"),
        "q006_most_viewed_pages": lambda: ranked("page_view_count", PAGE),
        "q007_longest_time_on_page": lambda: ranked("avg_time_on_page", PAGE),
        "q008_average_scroll_depth": lambda: a.metrics(["avg_scroll_depth"]),
        "q009_pages_scrolled_less_than_half": lambda: a.having(["avg_scroll_depth"], PAGE, F.col("avg_scroll_depth") < 0.5),
        "q010_lowest_engagement_pages": lambda: ranked(engaged, PAGE, up=True),
        "q011_users_with_many_pages_per_session": lambda: busy_sessions(5),
        "q012_identified_share": lambda: a.ratio_of("identified_user_count", "user_count"),
        "q013_top_entry_pages": lambda: top(a.entry_pages(), "entries", ["page"]),
        "q014_pages_after_home": lambda: a.next_pages(site.home),
        "q015_page_views_per_session": lambda: a.session_averages().select("avg_page_views"),
        "q016_average_lcp": lambda: a.metrics(["avg_lcp"]),
        "q017_good_lcp_share": lambda: a.share("loads", F.col(lcp) < 2500, value=F.col(lcp)),
        "q018_worst_lcp_pages": lambda: ranked("avg_lcp", PAGE),
        "q019_lcp_trend": lambda: a.trend(["avg_lcp"], "day", "past month"),
        "q020_lcp_mobile_desktop": lambda: a.compare(["avg_lcp"], "device type", ["Mobile", "Desktop"]),
        "q021_average_cls": lambda: a.metrics(["avg_cls"]),
        "q022_loads_with_high_cls": lambda: a.share("cumulative_layout_shifts", F.col(cls) > 0.1, value=F.col(cls)),
        "q023_worst_cls_pages": lambda: ranked("avg_cls", PAGE),
        "q024_poor_cls_pages": lambda: a.having(["avg_cls", "max_cls"], PAGE, F.col("avg_cls") > 0.25),
        "q025_average_inp": lambda: a.metrics(["avg_inp"]),
        "q026_good_inp_share": lambda: a.share("interaction_to_next_paints", F.col(inp) < 200, value=F.col(inp)),
        "q027_slowest_interaction_pages": lambda: ranked("avg_inp", PAGE),
        "q028_average_ttfb": lambda: a.metrics(["avg_ttfb"]),
        "q029_load_time_by_page": lambda: ranked("avg_load_time", PAGE),
        "q030_vitals_week_over_week": lambda: a.period_over_period(VITALS),
        "q031_slowest_browsers": lambda: ranked("avg_lcp", {"browser": "browser"}),
        "q032_rage_clicks_last_week": lambda: a.metrics(["rage_click_count"], when="last week"),
        "q033_rage_clicks_by_page": lambda: ranked("rage_click_count", PAGE),
        "q034_rage_clicked_elements": lambda: ranked(
            "rage_click_count", {"text": "target_text", "selector": "target_raw_selector"}),
        "q035_sessions_with_rage": lambda: a.having(
            ["rage_click_count"], {"session_id": "session_id"}, F.col("rage_click_count") > 3),
        "q036_rage_rate_by_device": lambda: a.ratio_of("rage_click_count", "click_count", DEVICE),
        "q037_dead_clicks_yesterday": lambda: a.metrics(["dead_click_count"], when="yesterday"),
        "q038_dead_clicks_by_page": lambda: ranked("dead_click_count", PAGE),
        "q039_top_dead_elements": lambda: ranked(
            "dead_click_count", {"text": "target_text", "selector": "target_raw_selector"}),
        "q040_dead_click_share": lambda: a.ratio_of("dead_click_count", "click_count"),
        "q041_mouse_thrashes": lambda: a.metrics(["mouse_thrash_count"]),
        "q042_frustrating_pages": lambda: top(a.frustration(PAGE), "score", ["page"]),
        "q043_frustrated_sessions": lambda: top(
            a.frustration({"session_id": "session_id"}).filter(F.col("score") >= site.high_frustration), "score", ["session_id"]),
        "q044_form_abandons_last_week": lambda: a.metrics(["form_abandon_count"], when="last week"),
        "q045_field_abandonment_rate": lambda: a.ratio_of(
            "form_abandon_count", "form_input_count", {"selector": "target_raw_selector"}),
        "q046_top_errors": lambda: ranked("total_exception_occurrences", {"message": "message"}, limit=10),
        "q047_unhandled_exceptions_last_week": lambda: a.metrics(["unhandled_exception_count"], when="last week"),
        "q048_errors_by_page": lambda: ranked("exception_event_count", PAGE),
        "q049_error_trend": lambda: a.trend(["exception_event_count"], "day", "past month"),
        "q050_users_with_errors": lambda: a.adoption("exceptions"),
        "q051_status_500_today": lambda: a.metrics([status_500], when="today"),
        "q052_failing_endpoints": lambda: ranked("total_failed_requests", {"endpoint": "endpoint"}),
        "q053_client_errors_by_endpoint": lambda: ranked("client_error_count", {"endpoint": "endpoint"}),
        "q054_failed_response_time": lambda: a.metrics([response]),
        "q055_server_and_client_errors": lambda: a.metrics(["server_error_count", "client_error_count"]),
        "q056_console_errors": lambda: a.metrics(["console_message_count"]),
        "q057_top_console_messages": lambda: ranked("console_message_count", {"message": "message"}),
        "q058_console_warnings_by_page": lambda: ranked(
            "console_message_count", PAGE, where={"console_message_level": "warn"}),
        "q059_checkouts_today": lambda: a.metrics([converted], when="today"),
        "q060_signup_conversion_rate": lambda: a.ratio_of(signed_up, SESSIONS),
        "q061_custom_events_by_name": lambda: ranked("custom_event_count", {"event_name": "event_name"}),
        "q062_conversion_by_device": lambda: conversion_rate(DEVICE),
        "q063_conversion_week_over_week": lambda: rate_change(),
        "q064_started_not_finished": lambda: funnel.started_not_finished(hits(PURCHASE_FUNNEL), 5),
        "q065_checkout_drop_off": drop_off,
        "q066_search_to_purchase_funnel": lambda: funnel.first_touch_funnel(hits(site.search_funnel), 3),
        "q067_exit_rates": lambda: top(a.exit_rates(), "exit_rate", ["page"]),
        "q068_experiment_users": lambda: a.adoption("custom_events", {"event_name": site.experiment}),
        "q069_survey_completions": lambda: a.metrics([events_named(site.survey)]),
        "q070_saw_banner": lambda: a.adoption("elements_seen", {"element_type": site.banner}),
        "q071_sessions_mobile_desktop": lambda: a.compare([SESSIONS], "device type", ["Mobile", "Desktop"]),
        "q072_mobile_user_share": mobile_share,
        "q073_tablet_engagement": lambda: a.compare(ENGAGEMENT, "device type", ["Tablet"]),
        "q074_best_converting_device": lambda: top(conversion_rate(DEVICE), "rate", ["device"], limit=1),
        "q075_sessions_by_browser": lambda: ranked(SESSIONS, {"browser": "browser"}),
        "q076_chrome_safari_performance": lambda: a.compare(
            ["avg_lcp", "avg_fcp", "avg_ttfb", "avg_load_time"], "browser", CHROME_SAFARI),
        "q077_errors_by_browser": lambda: ranked("exception_event_count", {"browser": "browser"}),
        "q078_rage_by_browser": lambda: ranked("rage_click_count", {"browser": "browser"}),
        "q079_users_by_country": lambda: ranked(VISITORS, {"country": "country"}),
        "q080_sessions_by_region": lambda: ranked(SESSIONS, {"region": "region"}),
        "q081_engagement_us_uk": lambda: a.compare(ENGAGEMENT, "country", ["United States", "United Kingdom"]),
        "q082_users_by_city": lambda: ranked(VISITORS, {"city": "city"}),
        "q083_users_by_os": lambda: ranked(VISITORS, {"os": "os"}),
        "q084_engagement_ios_android": lambda: a.compare(ENGAGEMENT, "os", ["iOS", "Android"]),
        "q085_crashes_by_os": lambda: ranked("crash_count", {"os": "os"}),
        "q086_user_growth": lambda: a.growth(),
        "q087_traffic_by_weekday": lambda: a.time_profile(["event_count"], "weekday"),
        "q088_sessions_by_hour": lambda: a.time_profile([SESSIONS], "hour_of_day"),
        "q089_this_week_and_last": lambda: a.window_versus_previous(CORE),
        "q090_page_views_month_over_month": lambda: a.period_over_period(["page_view_count"], "month"),
        "q091_special_day": lambda: a.day_versus_rest(["event_count", "click_count"], site.special_day),
        "q092_last_24_hours": lambda: a.metrics(CORE, when="last 24 hours"),
        "q093_yesterday_afternoon": lambda: a.metrics(
            CORE, when=clock_range(a.local_day(-1), "14:00:00", "16:00:00", a.tz)),
        "q094_weekday_weekend": lambda: a.metrics(ENGAGEMENT, {"is_weekend": "is_weekend"}),
        "q095_frustrated_checkout_errors": lambda: a.frustrated_with_errors(site.checkout_pages),
        "q096_poor_lcp_and_rage": lambda: a.having(
            ["avg_lcp", "rage_click_count"], PAGE, (F.col("avg_lcp") > 2500) & (F.col("rage_click_count") > 0)),
        "q097_load_time_and_abandonment": lambda: a.correlation("avg_load_time", "form_abandon_count", PAGE),
        "q098_frustrated_mobile_users": lambda: mobile_frustrated(2),
        "q099_users_with_most_sessions": lambda: ranked(SESSIONS, {"user_id": "user_id"}),
        "q100_identified_users_with_errors": identified_with_errors,
        "q101_frequent_visitors": lambda: a.having(
            [SESSIONS], {"user_id": "user_id"}, F.col("sessions") > 10, "this month"),
        "q102_error_spikes": lambda: a.anomalies("exception_event_count", "day").filter(
            F.col("bucket") == F.lit(a.local_day()).cast("timestamp")).withColumn(
            "is_spike", F.coalesce(F.col("z_score") > site.spike, F.lit(False))),
        "q103_traffic_drops": lambda: a.anomalies("page_view_count", "day", 7, PAGE).filter(F.col("ratio_to_mean") < 0.5),
        "q104_conversion_anomalies": lambda: with_z_score(
            conversion_rate({"bucket": "day"}, "all"), "rate", [], 7).filter(F.abs("z_score") > site.spike),
        "role_product_feature_use": lambda: ranked("element_seen_count", {"element": "elements_seen.target_text"}),
        "role_product_engagement_trend": lambda: a.trend(ENGAGEMENT, "week", "all"),
        "role_engineer_slow_pages": lambda: a.metrics(
            ["avg_lcp", "avg_ttfb", fact_percentile("p95_load_time", "page load time", 0.95)], PAGE),
        "role_designer_dead_elements": lambda: ranked("dead_click_count", {"element": "named element"}),
        "role_designer_scroll_stops": scroll_histogram,
        "role_analyst_conversion_drivers": contribution,
        "role_analyst_segment_behavior": lambda: a.metrics([*ENGAGEMENT, SESSIONS], {**DEVICE, "country": "country"}),
        "role_analyst_speed_and_engagement": lambda: a.correlation("avg_lcp", "avg_time_on_page", PAGE),
    }
