"""Oracle SQL for the metric layer, behaviour templates and the question catalogue."""

from __future__ import annotations

from checks.fx import with_fx

NOW = "timestamp '2024-01-30 18:00:00'"
MONTH = (f"{NOW} - INTERVAL 30 DAY", NOW)
WEEK = (f"{NOW} - INTERVAL 7 DAY", NOW)
DAY24 = (f"{NOW} - INTERVAL 1 DAY", NOW)
TODAY = ("timestamp '2024-01-30 00:00:00'", NOW)
YESTERDAY = ("timestamp '2024-01-29 00:00:00'", "timestamp '2024-01-30 00:00:00'")
THIS_MONTH = ("timestamp '2024-01-01 00:00:00'", NOW)
ALL = None

# Dimension expressions and the joins they need.
SP = "LEFT JOIN fx_source_properties sp ON sp.event_id = b.{key}"
PD = SP + " LEFT JOIN fx_page_definitions pd ON pd.id = sp.page_definition_id"
DIMS = {
    "page": ("pd.name", PD),
    "device": ("sp.user_agent_device", SP), "browser": ("sp.user_agent_browser", SP),
    "country": ("sp.location_country", SP), "region": ("sp.location_region", SP),
    "city": ("sp.location_city", SP), "os": ("sp.user_agent_operating_system", SP),
    "day": ("date_trunc('day', b.event_time)", ""), "week": ("date_trunc('week', b.event_time)", ""),
    "month": ("date_trunc('month', b.event_time)", ""), "hour": ("date_trunc('hour', b.event_time)", ""),
    "hour_of_day": ("hour(b.event_time)", ""), "weekday": ("dayofweek(b.event_time) + 1", ""),
    "is_weekend": ("dayofweek(b.event_time) IN (0, 6)", ""),
    "element": ("ed.name", "LEFT JOIN fx_events ev ON ev.id = b.{key} LEFT JOIN fx_element_definitions ed ON ed.id = ev.element_definition_id"),
    "event_definition": ("vd.name", "LEFT JOIN fx_event_definitions vd ON vd.id = b.event_definition_id"),
}


def span(when, col="b.event_time") -> str:
    return "true" if when is None else f"{col} >= {when[0]} AND {col} < {when[1]}"


def agg(base: str, select: str, by: dict[str, str] | None = None, where: str = "true", when=MONTH, tail: str = "") -> str:
    """SELECT dims, aggregates FROM base [joins] in a period.  ``by`` maps labels to DIMS keys or SQL."""
    by = by or {}
    key = "id" if base == "events" else "event_id"
    exprs, joins = [], []
    for label, dim in by.items():
        sql, join = DIMS.get(dim, (dim, ""))
        exprs.append(f"{sql} AS {label}")
        joins.append(join.format(key=key))
    for dim, (sql, join) in DIMS.items():
        if f"{{{dim}}}" in where:
            where = where.replace(f"{{{dim}}}", sql)
            joins.append(join.format(key=key))
    joins = [j for j in dict.fromkeys(joins) if j]
    if PD.format(key=key) in joins and SP.format(key=key) in joins:
        joins.remove(SP.format(key=key))
    timed = span(when)
    if base in ("users", "user_properties"):
        # Unique users in a period are those with an event in it.
        own = {"users": "id", "user_properties": "user_id"}[base]
        timed = "true" if when is None else f"b.{own} IN (SELECT e.user_id FROM fx_events e WHERE {span(when, 'e.event_time')})"
    group = f"GROUP BY {', '.join(str(i + 1) for i in range(len(by)))}" if by else ""
    comma = ", " if by else ""
    return f"SELECT {', '.join(exprs)}{comma}{select} FROM fx_{base} b {' '.join(joins)} WHERE {timed} AND ({where}) {group} {tail}"


def r(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


def big(expr: str, name: str) -> str:
    return f"cast({expr} AS bigint) AS {name}"


M = {
    "event_count": ("events", "count(b.id)"), "click_count": ("clicks", "count(*)"),
    "rage_click_count": ("clicks", "cast(sum(fs_rage_count) AS bigint)"),
    "dead_click_count": ("clicks", "cast(sum(fs_dead_count) AS bigint)"),
    "long_click_count": ("clicks", "count(CASE WHEN is_click_long = true THEN 1 END)"),
    "unhandled_click_count": ("clicks", "count(CASE WHEN is_click_unhandled = true THEN 1 END)"),
    "page_view_count": ("page_views", "count(*)"),
    "avg_time_on_page": ("page_views", "round(avg(duration_millis), 6)"),
    "avg_active_time_on_page": ("page_views", "round(avg(active_duration_millis), 6)"),
    "avg_scroll_depth": ("page_views", "round(avg(max_scroll_depth), 6)"),
    "avg_lcp": ("loads", "round(avg(largest_paint_time_millis), 6)"),
    "avg_fcp": ("loads", "round(avg(first_paint_time_millis), 6)"),
    "avg_ttfb": ("loads", "round(avg(time_to_first_byte_millis), 6)"),
    "avg_tti": ("loads", "round(avg(time_to_interactive_millis), 6)"),
    "avg_tbt": ("loads", "round(avg(total_blocking_time_millis), 6)"),
    "avg_dom_content_time": ("loads", "round(avg(dom_content_time_millis), 6)"),
    "avg_load_time": ("loads", "round(avg(load_time_millis), 6)"),
    "load_event_count": ("loads", "count(*)"),
    "avg_cls": ("cumulative_layout_shifts", "round(avg(cumulative_layout_shift), 6)"),
    "max_cls": ("cumulative_layout_shifts", "round(max(cumulative_layout_shift), 6)"),
    "avg_fid": ("first_input_delays", "round(avg(first_input_delay_millis), 6)"),
    "avg_inp": ("interaction_to_next_paints", "round(avg(interaction_to_next_paint_millis), 6)"),
    "max_inp": ("interaction_to_next_paints", "max(interaction_to_next_paint_millis)"),
    "inp_event_count": ("interaction_to_next_paints", "count(*)"),
    "poor_inp_count": ("interaction_to_next_paints", "count(CASE WHEN interaction_to_next_paint_millis > 500 THEN 1 END)"),
    "p75_inp": ("interaction_to_next_paints", "round(quantile_cont(interaction_to_next_paint_millis, 0.75), 6)"),
    "mouse_thrash_count": ("mouse_thrashes", "count(*)"), "form_abandon_count": ("form_abandons", "count(*)"),
    "form_input_count": ("form_input_changes", "count(*)"), "exception_event_count": ("exceptions", "count(*)"),
    "total_exception_occurrences": ("exceptions", "cast(sum(exception_count) AS bigint)"),
    "unhandled_exception_count": ("exceptions", "count(CASE WHEN is_exception_handled = false THEN 1 END)"),
    "console_message_count": ("console_messages", "count(*)"), "crash_count": ("crashes", "count(*)"),
    "client_error_count": ("requests", "count(CASE WHEN starts_with(request_status, '4') THEN 1 END)"),
    "server_error_count": ("requests", "count(CASE WHEN starts_with(request_status, '5') THEN 1 END)"),
    "total_failed_requests": ("requests", "count(*)"), "navigate_count": ("navigates", "count(*)"),
    "reload_count": ("navigates", "count(CASE WHEN navigate_reason = 'reload' THEN 1 END)"),
    "back_forward_count": ("navigates", "count(CASE WHEN navigate_reason = 'back_forward' THEN 1 END)"),
    "element_seen_count": ("elements_seen", "count(*)"),
    "avg_element_render_duration": ("elements_seen", "round(avg(element_render_duration_millis), 6)"),
    "avg_element_visible_duration": ("elements_seen", "round(avg(element_visible_duration_millis), 6)"),
    "custom_event_count": ("custom_events", "count(*)"),
    "desktop_event_count": ("source_properties", "count(CASE WHEN b.user_agent_device = 'Desktop' THEN 1 END)"),
    "mobile_event_count": ("source_properties", "count(CASE WHEN b.user_agent_device IN ('Mobile', 'Tablet') THEN 1 END)"),
    "user_count": ("users", "count(id)"), "identified_user_count": ("users", "count(uid)"),
    "paste_count": ("pastes", "count(*)"), "copy_count": ("copies", "count(*)"), "highlight_count": ("highlights", "count(*)"),
    "consent_given_count": ("consents", "count(CASE WHEN is_consent_given = true THEN 1 END)"),
    "consent_denied_count": ("consents", "count(CASE WHEN is_consent_given = false THEN 1 END)"),
    "property_update_count": ("element_properties", "count(*)"),
    "page_property_update_count": ("page_properties", "count(*)"),
    "user_property_count": ("user_properties", "count(user_id)"),
    "sessions": ("events", "count(DISTINCT session_id)"), "visitors": ("events", "count(DISTINCT b.user_id)"),
    "converted": ("custom_events", "count(CASE WHEN event_name = 'Checkout Success' THEN 1 END)"),
    "signups": ("custom_events", "count(CASE WHEN event_name = 'Signup' THEN 1 END)"),
}
RENAMED = {"converted": "named_event_count", "signups": "named_event_count"}


def m(names: str | list[str], by=None, where: str = "true", when=MONTH, tail: str = "") -> str:
    """Metrics by dimensions; several bases are combined by full outer join on the dimensions."""
    names = [names] if isinstance(names, str) else names
    bases: dict[str, list[str]] = {}
    for n in names:
        bases.setdefault(M[n][0], []).append(f"{M[n][1]} AS {RENAMED.get(n, n)}")
    parts = [agg(b, ", ".join(cols), by, where, when) for b, cols in bases.items()]
    if len(parts) == 1:
        return parts[0] + tail
    if not by:
        return "SELECT * FROM " + " CROSS JOIN ".join(f"({p}) p{i}" for i, p in enumerate(parts))
    dims = ", ".join(by)
    outs = ", ".join(f"any_value({RENAMED.get(n, n)}) AS {RENAMED.get(n, n)}" for n in names)
    return f"SELECT {dims}, {outs} FROM ({' UNION ALL BY NAME '.join(parts)}) u GROUP BY ALL {tail}"


def top(metric: str, by: dict, limit: int, up: bool = False, **kw) -> str:
    order = f" ORDER BY {metric} {'ASC' if up else 'DESC'} NULLS LAST, " + ", ".join(f"{x} ASC NULLS LAST" for x in by)
    return f"SELECT * FROM ({m(metric, by, **kw)}) t {order} LIMIT {limit}"


def rate(part: str, whole: str, by=None, when=MONTH) -> str:
    a, b = RENAMED.get(part, part), RENAMED.get(whole, whole)
    return (f"SELECT *, round(CASE WHEN {b} IS NOT NULL THEN coalesce({a}, 0) END / nullif({b}, 0), 6) AS rate "
            f"FROM ({m([part, whole], by, when=when)}) z")


def share(base: str, cond: str, by=None, when=MONTH) -> str:
    return agg(base, f"count(*) AS total, count(CASE WHEN {cond} THEN 1 END) AS matching, "
               f"round(count(CASE WHEN {cond} THEN 1 END) / nullif(count(*), 0), 6) AS share", by, when=when)


def change(sql: str, cols: list[str], by: list[str] = (), digits: int = 6) -> str:
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    w = f"({part}ORDER BY bucket)"
    outs = []
    for c in cols:
        prev = f"lag({c}) OVER {w}"
        outs += [f"{prev} AS {c}_previous", f"round({c} - {prev}, {digits}) AS {c}_change",
                 f"round(({c} - {prev}) / nullif({prev}, 0), {digits}) AS {c}_change_ratio"]
    return f"SELECT *, {', '.join(outs)} FROM ({sql}) x"


def unrounded(sql: str) -> str:
    """Metrics at full precision, for results computed from them."""
    import re

    return re.sub(r"round\((avg\(\w+\)|max\(\w+\)), 6\)", r"\1", sql)


def final(sql: str, cols: list[str]) -> str:
    return f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in cols)}) FROM ({sql}) f"


def zscore(sql: str, col: str, by: list[str] = (), n: int = 7, where: str = "true") -> str:
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    w = f"({part}ORDER BY bucket ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"""SELECT * FROM (
      SELECT * EXCLUDE (mu, sd), round(mu, 6) AS trailing_mean, round(sd, 6) AS trailing_stddev,
             round(({col} - mu) / nullif(sd, 0), 6) AS z_score, round({col} / nullif(mu, 0), 6) AS ratio_to_mean
      FROM (SELECT *, avg({col}) OVER {w} AS mu, stddev_samp({col}) OVER {w} AS sd FROM ({sql}) a) b) c WHERE {where}"""


def frustration(by: dict, where: str = "true", when=MONTH) -> str:
    dims = ", ".join(by)
    parts = [agg("clicks", "sum(fs_rage_count) AS rage, sum(fs_dead_count) AS dead, 0 AS thrash", by, when=when),
             agg("mouse_thrashes", "0 AS rage, 0 AS dead, count(*) AS thrash", by, when=when)]
    cols = ", ".join(f"cast(sum({c}) AS bigint) AS {c}" for c in ("rage", "dead", "thrash"))
    return (f"SELECT * FROM (SELECT {dims}, {cols}, cast(sum(rage + dead + thrash) AS bigint) AS score "
            f"FROM ({' UNION ALL '.join(parts)}) u GROUP BY ALL) f WHERE {where}")


SESSION_ROWS = f"""
  SELECT s.session_id, (epoch_us(s.ended) - epoch_us(s.started)) / 1e6 AS duration_seconds, s.events,
         coalesce(v.n, 0) AS page_views
  FROM (SELECT session_id, min(event_time) AS started, max(event_time) AS ended, count(*) AS events
        FROM fx_events b WHERE {span(MONTH)} GROUP BY 1) s
  LEFT JOIN (SELECT session_id, count(*) AS n FROM fx_page_views b WHERE {span(MONTH)} GROUP BY 1) v USING (session_id)"""

VIEWS = f"""
  SELECT b.session_id, b.user_id, b.event_id, b.event_time, pd.name AS page,
         row_number() OVER (PARTITION BY b.session_id ORDER BY b.event_time, b.event_id) AS rn,
         row_number() OVER (PARTITION BY b.session_id ORDER BY b.event_time DESC, b.event_id DESC) AS back,
         lead(pd.name) OVER (PARTITION BY b.session_id ORDER BY b.event_time, b.event_id) AS next_page
  FROM fx_page_views b {PD.format(key='event_id')} WHERE {span(MONTH)}"""

EXITS = f"""
  SELECT v.page, v.views, coalesce(x.exits, 0) AS exits, round(coalesce(x.exits, 0) / v.views, 6) AS exit_rate
  FROM (SELECT page, count(*) AS views FROM ({VIEWS}) a GROUP BY 1) v
  LEFT JOIN (SELECT page, count(*) AS exits FROM ({VIEWS}) b WHERE back = 1 GROUP BY 1) x ON v.page IS NOT DISTINCT FROM x.page"""


def adoption(base: str, where: str = "true") -> str:
    return f"""
      SELECT d.users, e.active_users, round(d.users / e.active_users, 6) AS share
      FROM (SELECT count(DISTINCT user_id) AS users FROM fx_{base} b WHERE {span(MONTH)} AND {where}) d,
           (SELECT count(DISTINCT user_id) AS active_users FROM fx_events b WHERE {span(MONTH)}) e"""


def funnel_hits(steps: list[tuple[str, str]]) -> str:
    """steps: (kind, comma-separated quoted names)."""
    parts = []
    for i, (kind, names) in enumerate(steps, 1):
        join = (f"JOIN fx_source_properties sp ON sp.event_id = b.id JOIN fx_page_definitions pd ON pd.id = sp.page_definition_id "
                f"AND pd.name IN ({names})") if kind == "page" else (
                f"JOIN fx_custom_events ce ON ce.event_id = b.id AND ce.event_name IN ({names})")
        parts.append(f"SELECT b.user_id, b.session_id, b.event_time, {i} AS step FROM fx_events b {join} WHERE {span(MONTH)}")
    return " UNION ALL ".join(parts)


def times(steps: list[tuple[str, str]]) -> str:
    n = len(steps)
    cols = ", ".join(f"min(CASE WHEN step = {i} THEN event_time END) AS t{i}" for i in range(1, n + 1))
    return f"SELECT * FROM (SELECT user_id, session_id, {cols} FROM ({funnel_hits(steps)}) h GROUP BY ALL) g WHERE t1 IS NOT NULL"


def in_order(k: int) -> str:
    return " AND ".join(f"t{i} > t{i - 1}" for i in range(2, k + 1))


PURCHASE = [("page", "'ProductPage', 'Search'"), ("page", "'Checkout Billing'"), ("page", "'Checkout Payment'"),
            ("page", "'Checkout Review'"), ("event", "'Checkout Success'")]
SEARCH = [("page", "'Home'"), ("page", "'Search'"), ("event", "'Checkout Success'")]

ENGAGEMENT = ["page_view_count", "avg_time_on_page", "avg_active_time_on_page", "avg_scroll_depth"]
CORE = ["sessions", "visitors", "event_count", "page_view_count", "click_count", "exception_event_count"]
P, D = {"page": "page"}, {"device": "device"}


def seg(names, dim, values):
    quoted = ", ".join(f"'{v}'" for v in values)
    return m(names, {"segment": dim}, where=f"{{{dim}}} IN ({quoted})")


def questions() -> dict[str, str]:
    el = {"text": "b.target_text", "selector": "b.target_raw_selector"}
    rage_dead_pages = "page IN ('Checkout Billing', 'Checkout Payment', 'Checkout Review')"
    q = {
        "q001_unique_visitors_last_week": m("visitors", when=WEEK),
        "q002_sessions_today": m("sessions", when=TODAY),
        "q003_page_views_yesterday": m("page_view_count", when=YESTERDAY),
        "q004_average_session_duration": f"SELECT round(avg(duration_seconds), 6) AS avg_duration_seconds FROM ({SESSION_ROWS}) s",
        "q005_daily_active_users": m("visitors", {"bucket": "day"}),
        "q006_most_viewed_pages": m("page_view_count", P),
        "q007_longest_time_on_page": m("avg_time_on_page", P),
        "q008_average_scroll_depth": m("avg_scroll_depth"),
        "q009_pages_scrolled_less_than_half": m("avg_scroll_depth", P, tail="HAVING avg(max_scroll_depth) < 0.5"),
        "q010_lowest_engagement_pages": agg("page_views", r("sum(active_duration_millis) / sum(duration_millis)", "engagement_rate"), P),
        "q011_users_with_many_pages_per_session": f"""SELECT count(DISTINCT user_id) AS users FROM (
            SELECT session_id, user_id, count(*) AS n FROM fx_page_views b WHERE {span(MONTH)} GROUP BY ALL) s WHERE n > 5""",
        "q012_identified_share": rate("identified_user_count", "user_count"),
        "q013_top_entry_pages": f"SELECT page, count(*) AS entries FROM ({VIEWS}) v WHERE rn = 1 GROUP BY 1",
        "q014_pages_after_home": f"SELECT next_page, count(*) AS moves FROM ({VIEWS}) v WHERE page = 'Home' GROUP BY 1",
        "q015_page_views_per_session": f"SELECT round(avg(page_views), 6) AS avg_page_views FROM ({SESSION_ROWS}) s",
        "q016_average_lcp": m("avg_lcp"),
        "q017_good_lcp_share": share("loads", "largest_paint_time_millis < 2500"),
        "q018_worst_lcp_pages": m("avg_lcp", P),
        "q019_lcp_trend": m("avg_lcp", {"bucket": "day"}),
        "q020_lcp_mobile_desktop": seg("avg_lcp", "device", ["Mobile", "Desktop"]),
        "q021_average_cls": m("avg_cls"),
        "q022_loads_with_high_cls": share("cumulative_layout_shifts", "cumulative_layout_shift > 0.1"),
        "q023_worst_cls_pages": m("avg_cls", P),
        "q024_poor_cls_pages": m(["avg_cls", "max_cls"], P, tail="HAVING avg(cumulative_layout_shift) > 0.25"),
        "q025_average_inp": m("avg_inp"),
        "q026_good_inp_share": share("interaction_to_next_paints", "interaction_to_next_paint_millis < 200"),
        "q027_slowest_interaction_pages": m("avg_inp", P),
        "q028_average_ttfb": m("avg_ttfb"),
        "q029_load_time_by_page": m("avg_load_time", P),
        "q030_vitals_week_over_week": final(change(unrounded(m(["avg_lcp", "avg_cls", "avg_inp"], {"bucket": "week"}, when=ALL)),
            ["avg_lcp", "avg_cls", "avg_inp"]), [f"avg_{x}{s}" for x in ("lcp", "cls", "inp") for s in ("", "_previous")]),
        "q031_slowest_browsers": m("avg_lcp", {"browser": "browser"}),
        "q032_rage_clicks_last_week": m("rage_click_count", when=WEEK),
        "q033_rage_clicks_by_page": m("rage_click_count", P),
        "q034_rage_clicked_elements": m("rage_click_count", el),
        "q035_sessions_with_rage": m("rage_click_count", {"session_id": "b.session_id"}, tail="HAVING sum(fs_rage_count) > 3"),
        "q036_rage_rate_by_device": rate("rage_click_count", "click_count", D),
        "q037_dead_clicks_yesterday": m("dead_click_count", when=YESTERDAY),
        "q038_dead_clicks_by_page": m("dead_click_count", P),
        "q039_top_dead_elements": m("dead_click_count", el),
        "q040_dead_click_share": rate("dead_click_count", "click_count"),
        "q041_mouse_thrashes": m("mouse_thrash_count"),
        "q042_frustrating_pages": frustration(P),
        "q043_frustrated_sessions": frustration({"session_id": "b.session_id"}, "score >= 3"),
        "q044_form_abandons_last_week": m("form_abandon_count", when=WEEK),
        "q045_field_abandonment_rate": rate("form_abandon_count", "form_input_count", {"selector": "b.target_raw_selector"}),
        "q046_top_errors": top("total_exception_occurrences", {"message": "b.message"}, 10),
        "q047_unhandled_exceptions_last_week": m("unhandled_exception_count", when=WEEK),
        "q048_errors_by_page": m("exception_event_count", P),
        "q049_error_trend": m("exception_event_count", {"bucket": "day"}),
        "q050_users_with_errors": adoption("exceptions"),
        "q051_status_500_today": agg("requests", "count(CASE WHEN request_status = '500' THEN 1 END) AS status_500_count", when=TODAY),
        "q052_failing_endpoints": m("total_failed_requests", {"endpoint": "b.request_url_full_url"}),
        "q053_client_errors_by_endpoint": m("client_error_count", {"endpoint": "b.request_url_full_url"}),
        "q054_failed_response_time": agg("requests", r("avg(request_duration_millis)", "avg_request_duration")),
        "q055_server_and_client_errors": m(["server_error_count", "client_error_count"]),
        "q056_console_errors": m("console_message_count"),
        "q057_top_console_messages": m("console_message_count", {"message": "b.message"}),
        "q058_console_warnings_by_page": m("console_message_count", P, where="console_message_level = 'warn'"),
        "q059_checkouts_today": m("converted", when=TODAY),
        "q060_signup_conversion_rate": rate("signups", "sessions"),
        "q061_custom_events_by_name": m("custom_event_count", {"event_name": "b.event_name"}),
        "q062_conversion_by_device": rate("converted", "sessions", D),
        "q063_conversion_week_over_week": final(change(
            rate("converted", "sessions", {"bucket": "week"}, ALL).replace("round(CASE", "(CASE").replace(", 6) AS rate", ") AS rate"),
            ["rate"]), ["rate", "rate_previous"]),
        "q064_started_not_finished": f"""SELECT count(*) AS users FROM (SELECT user_id, bool_or(coalesce({in_order(5)}, false)) AS ok
            FROM ({times(PURCHASE)}) t GROUP BY 1) u WHERE NOT ok""",
        "q065_checkout_drop_off": f"""SELECT a AS stp2_sessions, b AS stp3_sessions, round(1 - b / nullif(a, 0), 6) AS drop_off FROM (
            SELECT count(CASE WHEN {in_order(2)} THEN 1 END) AS a, count(CASE WHEN {in_order(3)} THEN 1 END) AS b
            FROM ({times(PURCHASE)}) t) u""",
        "q066_search_to_purchase_funnel": f"""SELECT s1 AS stp1_sessions, s2 AS stp2_sessions, s3 AS stp3_sessions,
            round(s2 / nullif(s1, 0) * 100, 1) AS stp1_to_stp2_pct, round(s3 / nullif(s2, 0) * 100, 1) AS stp2_to_stp3_pct,
            round(s3 / nullif(s1, 0) * 100, 1) AS overall_pct FROM (
            SELECT count(DISTINCT session_id) AS s1, count(CASE WHEN {in_order(2)} THEN 1 END) AS s2,
                   count(CASE WHEN {in_order(3)} THEN 1 END) AS s3 FROM ({times(SEARCH)}) t) u""",
        "q067_exit_rates": EXITS,
        "q068_experiment_users": adoption("custom_events", "event_name = 'Experiment Viewed'"),
        "q069_survey_completions": agg("custom_events", "count(CASE WHEN event_name = 'NPS Survey' THEN 1 END) AS named_event_count"),
        "q070_saw_banner": adoption("elements_seen", "element_type = 'banner'"),
        "q071_sessions_mobile_desktop": seg("sessions", "device", ["Mobile", "Desktop"]),
        "q072_mobile_user_share": f"""SELECT *, round(mobile_users / all_visitors, 6) AS share FROM
            (SELECT count(DISTINCT b.user_id) AS mobile_users FROM fx_events b {SP.format(key='id')}
             WHERE {span(MONTH)} AND sp.user_agent_device = 'Mobile') a,
            (SELECT count(DISTINCT user_id) AS all_visitors FROM fx_events b WHERE {span(MONTH)}) c""",
        "q073_tablet_engagement": seg(ENGAGEMENT, "device", ["Tablet"]),
        "q074_best_converting_device": f"SELECT * FROM ({rate('converted', 'sessions', D)}) t ORDER BY rate DESC NULLS LAST, device LIMIT 1",
        "q075_sessions_by_browser": m("sessions", {"browser": "browser"}),
        "q076_chrome_safari_performance": seg(["avg_lcp", "avg_fcp", "avg_ttfb", "avg_load_time"], "browser", ["Chrome", "Safari"]),
        "q077_errors_by_browser": m("exception_event_count", {"browser": "browser"}),
        "q078_rage_by_browser": m("rage_click_count", {"browser": "browser"}),
        "q079_users_by_country": m("visitors", {"country": "country"}),
        "q080_sessions_by_region": m("sessions", {"region": "region"}),
        "q081_engagement_us_uk": seg(ENGAGEMENT, "country", ["United States", "United Kingdom"]),
        "q082_users_by_city": m("visitors", {"city": "city"}),
        "q083_users_by_os": m("visitors", {"os": "os"}),
        "q084_engagement_ios_android": seg(ENGAGEMENT, "os", ["iOS", "Android"]),
        "q085_crashes_by_os": m("crash_count", {"os": "os"}),
        "q086_user_growth": f"""SELECT bucket, new_users, cast(sum(new_users) OVER (ORDER BY bucket) AS bigint) AS total_users FROM (
            SELECT date_trunc('week', f) AS bucket, count(*) AS new_users FROM (SELECT user_id, min(event_time) AS f
            FROM fx_events b WHERE {span((NOW + ' - INTERVAL 90 DAY', NOW))} GROUP BY 1) u GROUP BY 1) w""",
        "q087_traffic_by_weekday": m("event_count", {"weekday": "weekday"}),
        "q088_sessions_by_hour": m("sessions", {"hour_of_day": "hour_of_day"}),
        "q089_this_week_and_last": f"""SELECT *, 'current' AS "window" FROM ({m(CORE, when=WEEK)}) a
            UNION ALL SELECT *, 'previous' FROM ({m(CORE, when=(NOW + ' - INTERVAL 14 DAY', NOW + ' - INTERVAL 7 DAY'))}) b""",
        "q090_page_views_month_over_month": change(m("page_view_count", {"bucket": "month"}, when=ALL), ["page_view_count"]),
        "q091_special_day": "SELECT " + ", ".join(
            f"max(CASE WHEN bucket = date '2024-01-15' THEN {c} END) AS {c}_day, "
            f"round(avg(CASE WHEN bucket <> date '2024-01-15' THEN {c} END), 6) AS {c}_other_days"
            for c in ("event_count", "click_count")) + f" FROM ({m(['event_count', 'click_count'], {'bucket': 'day'}, when=ALL)}) d",
        "q092_last_24_hours": m(CORE, when=DAY24),
        "q093_yesterday_afternoon": m(CORE, when=("timestamp '2024-01-29 14:00:00'", "timestamp '2024-01-29 16:00:00'")),
        "q094_weekday_weekend": m(ENGAGEMENT, {"is_weekend": "is_weekend"}),
        "q095_frustrated_checkout_errors": f"""SELECT f.user_id, cast(sum(score) AS bigint) AS score, cast(sum(e.exception_event_count) AS bigint) AS errors
            FROM ({frustration({'user_id': 'b.user_id', 'page': 'page'}, rage_dead_pages + ' AND score > 0')}) f
            JOIN ({m('exception_event_count', {'user_id': 'b.user_id', 'page': 'page'})}) e ON f.user_id = e.user_id AND f.page = e.page
            GROUP BY 1""",
        "q096_poor_lcp_and_rage": f"SELECT * FROM ({m(['avg_lcp', 'rage_click_count'], P)}) t WHERE avg_lcp > 2500 AND rage_click_count > 0",
        "q097_load_time_and_abandonment": f"""SELECT round(corr(avg_load_time, coalesce(form_abandon_count, 0)), 6) AS correlation, count(*) AS "groups"
            FROM ({unrounded(m(['avg_load_time', 'form_abandon_count'], P))}) t WHERE avg_load_time IS NOT NULL""",
        "q098_frustrated_mobile_users": f"SELECT user_id, score FROM ({frustration({'user_id': 'b.user_id', 'device': 'device'})}) f WHERE device = 'Mobile' AND score >= 2",
        "q099_users_with_most_sessions": m("sessions", {"user_id": "b.user_id"}),
        "q100_identified_users_with_errors": f"""SELECT u.uid, count(*) AS errors FROM fx_exceptions b JOIN fx_users u ON u.id = b.user_id
            WHERE u.uid IS NOT NULL AND {span(MONTH)} GROUP BY 1""",
        "q101_frequent_visitors": m("sessions", {"user_id": "b.user_id"}, when=THIS_MONTH, tail="HAVING count(DISTINCT session_id) > 10"),
        "q102_error_spikes": f"""SELECT *, coalesce(z_score > 2, false) AS is_spike FROM (
            {zscore(m("exception_event_count", {"bucket": "day"}, when=ALL), "exception_event_count")}) t
            WHERE bucket = TIMESTAMP '2024-01-30 00:00:00'""",
        "q103_traffic_drops": zscore(m("page_view_count", {"page": "page", "bucket": "day"}, when=ALL), "page_view_count", ["page"],
                                     where="page_view_count / trailing_mean < 0.5"),
        "q104_conversion_anomalies": "SELECT * FROM (" + final(zscore(
            rate("converted", "sessions", {"bucket": "day"}, ALL).replace("round(CASE", "(CASE").replace(", 6) AS rate", ") AS rate"),
            "rate"), ["rate"]) + ") t WHERE abs(z_score) > 2",
        "role_product_feature_use": m("element_seen_count", {"element": "b.target_text"}),
        "role_product_engagement_trend": m(ENGAGEMENT, {"bucket": "week"}, when=ALL),
        "role_engineer_slow_pages": agg("loads", "round(avg(largest_paint_time_millis), 6) AS avg_lcp, round(avg(time_to_first_byte_millis), 6) AS avg_ttfb, "
                                        "round(quantile_cont(load_time_millis, 0.95), 6) AS p95_load_time", P),
        "role_designer_dead_elements": m("dead_click_count", {"element": "element"}),
        "role_designer_scroll_stops": f"""SELECT cast(least(floor(max_scroll_depth * 10), 9) AS bigint) AS tenth, count(*) AS views
            FROM fx_page_views b WHERE {span(MONTH)} GROUP BY 1""",
        "role_analyst_conversion_drivers": f"""
            WITH c AS (SELECT *, n - lag(n) OVER (PARTITION BY device ORDER BY bucket) AS d FROM (
              {m('converted', {'device': 'device', 'bucket': 'week'}, when=ALL).replace('named_event_count', 'n')}) x)
            SELECT c.device, c.bucket, n AS named_event_count, d AS named_event_count_change, cast(t.d2 AS bigint) AS total_change,
                   round(d / nullif(t.d2, 0), 6) AS part
            FROM c JOIN (SELECT bucket, sum(d) AS d2 FROM c GROUP BY 1) t ON c.bucket = t.bucket""",
        "role_analyst_segment_behavior": m([*ENGAGEMENT, "sessions"], {"device": "device", "country": "country"}),
        "role_analyst_speed_and_engagement": f"""SELECT round(corr(avg_lcp, coalesce(avg_time_on_page, 0)), 6) AS correlation, count(*) AS "groups"
            FROM ({unrounded(m(['avg_lcp', 'avg_time_on_page'], P))}) t WHERE avg_lcp IS NOT NULL""",
    }
    return {k: with_fx(f"SELECT * FROM ({v}) answer") for k, v in q.items()}


def metric_layer() -> dict[str, str]:
    by_base = {"users": {"known": "b.uid"}, "user_properties": {"tier": "b.loyalty_tier"}}
    out: dict[str, str] = {}
    bases: dict[str, list[str]] = {}
    for name, (base, _) in M.items():
        if name not in ("sessions", "visitors", *RENAMED):
            bases.setdefault(base, []).append(name)
    for base, names in bases.items():
        out[f"metric_{base}"] = m(names, by_base.get(base, P), when=ALL)
    cells = {"page": "page", "day": "day", "device": "device"}
    out["k21_metrics_across_bases"] = m(
        ["sessions", "page_view_count", "rage_click_count", "crash_count", "p75_inp"], cells,
        where="{country} IN ('Japan', 'Germany')")
    out["k21_user_count_last_week"] = m(["user_count", "identified_user_count"], when=WEEK)
    page = {"page": "page"}
    each = lambda fn, facts: ", ".join(f"{fn}(b.{f}){'::BIGINT' if fn == 'sum' else ''} AS {fn}_{f}" for f in facts)
    out["k21_facts_of_views"] = agg("page_views", each("max", (
        "active_duration_millis", "inactive_duration_millis", "duration_millis", "max_scroll_depth")), page, when=ALL)
    out["k21_facts_of_loads"] = agg("loads", each("sum", (
        "first_paint_time_millis", "dom_content_time_millis", "time_to_interactive_millis", "total_blocking_time_millis")), page, when=ALL)
    delays = agg("first_input_delays", each("min", ("first_input_delay_millis",)), page, when=ALL)
    drawn = agg("elements_seen", each("min", ("element_render_duration_millis", "element_visible_duration_millis")), page, when=ALL)
    out["k21_facts_of_inputs_and_elements"] = f"""SELECT page, any_value(min_first_input_delay_millis) AS min_first_input_delay_millis,
      any_value(min_element_render_duration_millis) AS min_element_render_duration_millis,
      any_value(min_element_visible_duration_millis) AS min_element_visible_duration_millis
      FROM ({delays} UNION ALL BY NAME {drawn}) u GROUP BY page"""
    out["k21_metrics_by_synonym"] = m(
        ["page_view_count", "avg_lcp", "server_error_count"], {"browser": "browser", "operating_system": "os"}, when=ALL)
    out["k21_metrics_by_definitions"] = f"""
      SELECT ed.name AS element, vd.name AS event, count(*) AS event_count, count(DISTINCT b.user_id) AS visitors
      FROM fx_events b LEFT JOIN fx_element_definitions ed ON ed.id = b.element_definition_id
      LEFT JOIN fx_event_definitions vd ON vd.id = b.event_definition_id WHERE {span(MONTH)} GROUP BY ALL"""
    part = lambda base, col: f"""
      SELECT u.uid, up.loyalty_tier AS tier, count(*) AS {col} FROM fx_{base} b LEFT JOIN fx_users u ON u.id = b.user_id
      LEFT JOIN fx_user_properties up ON up.user_id = b.user_id WHERE {span(MONTH)} GROUP BY ALL"""
    out["k21_metrics_by_user"] = f"""
      SELECT uid, tier, any_value(click_count) AS click_count, any_value(exception_event_count) AS exception_event_count
      FROM ({part('clicks', 'click_count')} UNION ALL BY NAME {part('exceptions', 'exception_event_count')}) x GROUP BY ALL"""
    return {k: with_fx(f"SELECT * FROM ({v}) answer") for k, v in out.items()}


def templates() -> dict[str, str]:
    every = lambda text: text.replace(span(MONTH), "true")
    denver = "b.event_time - INTERVAL 7 HOUR"
    q = {
        "b01_total_in_period": m(["click_count", "rage_click_count", "crash_count"], when=WEEK),
        "b02_top_n_by_dimension": top("click_count", {"city": "city"}, 7),
        "b03_weekly_trend": m(["avg_inp", "poor_inp_count"], {"bucket": "week"}, when=ALL),
        "b04_share_by_segment": share("loads", "time_to_first_byte_millis < 800", D),
        "b04_vital_ratings": " UNION ALL ".join(
            f"SELECT '{v}' AS vital, count(*) AS readings, count(CASE WHEN {c} < {g} THEN 1 END) AS good, "
            f"count(CASE WHEN {c} {p} THEN 1 END) AS poor, round(count(CASE WHEN {c} < {g} THEN 1 END) / count(*), 6) AS good_share FROM fx_{b}"
            for v, b, c, g, p in [
                ("lcp", "loads", "largest_paint_time_millis", 2500, ">= 2500"),
                ("cls score", "cumulative_layout_shifts", "cumulative_layout_shift", 0.1, "> 0.25"),
                ("inp", "interaction_to_next_paints", "interaction_to_next_paint_millis", 200, "> 500"),
                ("ttfb", "loads", "time_to_first_byte_millis", 800, ">= 800")]),
        "b05_side_by_side": f"""SELECT country, max(CASE WHEN segment = 'Mobile' THEN page_view_count END) AS left_value,
            max(CASE WHEN segment = 'Desktop' THEN page_view_count END) AS right_value,
            max(CASE WHEN segment = 'Mobile' THEN page_view_count END) - max(CASE WHEN segment = 'Desktop' THEN page_view_count END) AS difference
            FROM ({m('page_view_count', {'country': 'country', 'segment': 'device'}, where="{device} IN ('Mobile', 'Desktop')")}) t GROUP BY 1""",
        "b06_change_by_segment": change(m("event_count", {"device": "device", "bucket": "week"}, when=ALL), ["event_count"], ["device"]),
        "b07_session_averages": every(f"""SELECT count(*) AS sessions, round(avg(duration_seconds), 6) AS avg_duration_seconds,
            round(avg(events), 6) AS avg_events, round(avg(page_views), 6) AS avg_page_views FROM ({SESSION_ROWS}) s"""),
        "b08_entities_over_threshold": m(["event_count", "sessions"], {"user_id": "b.user_id"}, when=ALL, tail="HAVING count(b.id) >= 80"),
        "b09_entry_and_exit_pages": every(f"""SELECT session_id, max(CASE WHEN rn = 1 THEN page END) AS entry_page,
            max(CASE WHEN back = 1 THEN page END) AS exit_page FROM ({VIEWS}) v GROUP BY 1"""),
        "b10_next_page": every(f"SELECT next_page, count(*) AS moves FROM ({VIEWS}) v WHERE page = 'Search' GROUP BY 1"),
        "b11_step_reach": every(f"""SELECT step, count(DISTINCT session_id) AS sessions, count(DISTINCT user_id) AS users
            FROM ({funnel_hits(PURCHASE)}) h GROUP BY 1"""),
        "b12_ratio_of_two_facts": rate("dead_click_count", "page_view_count", P, ALL),
        "b13_frustration_score": frustration({"session_id": "b.session_id", "user_id": "b.user_id"}, when=ALL),
        "b14_signals_together": f"""SELECT f.user_id, cast(sum(score) AS bigint) AS score, cast(sum(e.exception_event_count) AS bigint) AS errors
            FROM ({frustration({'user_id': 'b.user_id', 'page': 'page'}, "page IN ('ProductPage', 'Search', 'Checkout Review') AND score > 0", ALL)}) f
            JOIN ({m('exception_event_count', {'user_id': 'b.user_id', 'page': 'page'}, when=ALL)}) e ON f.user_id = e.user_id AND f.page = e.page
            GROUP BY 1""",
        "b15_correlation": f"""SELECT round(corr(event_count, coalesce(exception_event_count, 0)), 6) AS correlation, count(*) AS "groups"
            FROM ({m(['event_count', 'exception_event_count'], {'user_id': 'b.user_id'}, when=ALL)}) t WHERE event_count IS NOT NULL""",
        "b16_anomaly_scores": zscore(m("event_count", {"device": "device", "bucket": "day"}, when=ALL), "event_count", ["device"], 5),
        "b17_time_profile": m(["event_count", "sessions"], {"hour_of_day": f"hour({denver})"}),
        "b18_weekday_weekend": m(["visitors", "event_count"], {"is_weekend": "is_weekend"}, when=ALL),
        "b19_adoption": f"""SELECT d.users, e.active_users, round(d.users / e.active_users, 6) AS share
            FROM (SELECT count(DISTINCT b.user_id) AS users FROM fx_clicks b {PD.format(key='event_id')} WHERE pd.name = 'Search') d,
                 (SELECT count(DISTINCT user_id) AS active_users FROM fx_events) e""",
        "b20_growth": """SELECT bucket, new_users, cast(sum(new_users) OVER (ORDER BY bucket) AS bigint) AS total_users FROM (
            SELECT date_trunc('day', f) AS bucket, count(*) AS new_users FROM (SELECT user_id, min(event_time) AS f FROM fx_events GROUP BY 1) u GROUP BY 1) w""",
    }
    return {k: with_fx(f"SELECT * FROM ({v}) answer") for k, v in q.items()}


def operators() -> dict[str, str]:
    hits = funnel_hits(PURCHASE).replace(span(MONTH), "true")
    w = "(PARTITION BY user_id ORDER BY event_time, id)"
    q = {
        "s12_create_and_append": "SELECT event_id, user_id, event_time, target_text FROM fx_clicks",
        "s16_sampled_users": "SELECT * FROM fx_export_users WHERE uid IS NOT NULL AND uid <> '' ORDER BY uid LIMIT 50",
        "fx_sessions": "SELECT id, session_id FROM fx_base",
        "p1_local_day_rows": "SELECT id FROM fx_events WHERE cast(event_time - INTERVAL 7 HOUR AS date) = date '2024-01-10'",
        "j10_after_session_mark": f"""SELECT session_id, event_time FROM ({hits}) h WHERE step = 2 AND EXISTS (
            SELECT 1 FROM ({hits}) p WHERE p.step = 1 AND p.session_id = h.session_id AND p.event_time < h.event_time)""",
        "w1_w3_w4_user_order": f"""SELECT id, row_number() OVER {w} AS rn, count(*) OVER (PARTITION BY user_id) AS n,
            lag(event_time) OVER {w} AS previous_time, lead(event_type) OVER {w} AS next_type FROM fx_events""",
        "o3_latest_event_per_user": "SELECT user_id, arg_max(event_type, event_time) AS event_type, max(event_time) AS event_time FROM fx_events GROUP BY 1",
        "p15_unexpected_clicks": """SELECT event_id, fs_rage_count, fs_dead_count FROM fx_clicks WHERE NOT (
            (fs_rage_count = 0 AND fs_dead_count = 0) OR (fs_rage_count = 0 AND fs_dead_count = 1))""",
        "g11_absent_kinds": """SELECT kind AS absent FROM (VALUES ('click'), ('purchase'), ('refund'), ('view'), ('chat')) k(kind)
            WHERE (SELECT count(*) FROM fx_events e WHERE e.event_type = kind) = 0""",
        "u1_funnel_hits": hits,
        "x1_decoded_campaign": """SELECT event_id, url_decode(nullif(regexp_extract(url_full_url, '[?&]utm_campaign=([^&]+)', 1), '')) AS campaign
            FROM fx_source_properties""",
        "x9_local_calendar": "SELECT strftime(event_time - INTERVAL 7 HOUR, '%Y-%m-%d %H') AS hour, count(*) AS events FROM fx_events GROUP BY 1",
    }
    out = {k: with_fx(f"SELECT * FROM ({v}) answer") for k, v in q.items()}
    out["s1_source_views"] = "SELECT event_type, count(*) AS events, (SELECT count(*) FROM customer) AS buyers FROM events GROUP BY 1"
    return out
