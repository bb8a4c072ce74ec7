"""Oracle SQL for counts, funnels, staging, attribution and quality checks."""

from __future__ import annotations

from checks.fx import with_fx

# Denver is UTC-7 throughout the data's month.
LOCAL_DAY = "cast(event_time - INTERVAL 7 HOUR AS date) = date '2024-01-10'"

AS_OF = "timestamp '2024-01-31 00:00:00'"


STEP_NAMES = """(VALUES ('ProductPage', 1), ('Search', 1), ('Checkout Billing', 2), ('Checkout Payment', 3),
  ('Checkout Review', 4)) st(name, step)"""


BACK_TO_SEARCH = "(VALUES ('Search', 1), ('ProductPage', 2), ('Search', 3)) st(name, step)"


def funnel_hits(where: str, names: str = STEP_NAMES) -> str:
    return f"""
      SELECT e.user_id, e.session_id, e.event_time, tag.step
      FROM (SELECT * FROM fx_events WHERE {where}) e JOIN (
        SELECT sp.event_id, st.step FROM fx_source_properties sp
        JOIN fx_page_definitions pd ON pd.id = sp.page_definition_id JOIN {names} ON st.name = pd.name
        UNION ALL SELECT event_id, 5 FROM fx_custom_events WHERE event_name = 'Checkout Success') tag ON tag.event_id = e.id"""


def rates(n: int = 5) -> str:
    pct = lambda a, b: f"round(s{a} / nullif(s{b}, 0) * 100, 1)"
    cols = [f"s{i} AS stp{i}_sessions" for i in range(1, n + 1)]
    cols += [f"{pct(i, i - 1)} AS stp{i - 1}_to_stp{i}_pct" for i in range(2, n + 1)]
    return ", ".join(cols) + f", {pct(n, 1)} AS overall_pct"


FIRST_TOUCH_FUNNEL = f"""
  SELECT {rates()} FROM (
    SELECT count(DISTINCT session_id) AS s1,
           count(CASE WHEN t2 > t1 THEN 1 END) AS s2,
           count(CASE WHEN t2 > t1 AND t3 > t2 THEN 1 END) AS s3,
           count(CASE WHEN t2 > t1 AND t3 > t2 AND t4 > t3 THEN 1 END) AS s4,
           count(CASE WHEN t2 > t1 AND t3 > t2 AND t4 > t3 AND t5 > t4 THEN 1 END) AS s5
    FROM (SELECT user_id, session_id, min(CASE WHEN step = 1 THEN event_time END) AS t1,
                 min(CASE WHEN step = 2 THEN event_time END) AS t2, min(CASE WHEN step = 3 THEN event_time END) AS t3,
                 min(CASE WHEN step = 4 THEN event_time END) AS t4, min(CASE WHEN step = 5 THEN event_time END) AS t5
          FROM hits GROUP BY user_id, session_id) x
    WHERE t1 IS NOT NULL) y"""


def chained_funnel(n: int = 5) -> str:
    ctes = ["c1 AS (SELECT user_id, session_id, min(event_time) AS at FROM hits WHERE step = 1 GROUP BY ALL)"]
    for i in range(2, n + 1):
        ctes.append(
            f"c{i} AS (SELECT user_id, session_id, min(event_time) AS at FROM hits h WHERE step = {i} AND EXISTS "
            f"(SELECT 1 FROM c{i - 1} p WHERE p.session_id = h.session_id AND p.at < h.event_time) GROUP BY ALL)")
    scalars = ", ".join(f"(SELECT count(DISTINCT session_id) FROM c{i}) AS s{i}" for i in range(1, n + 1))
    return f"SELECT {rates(n)} FROM (WITH {', '.join(ctes)} SELECT {scalars}) z"


def param(name: str) -> str:
    return f"nullif(regexp_extract(url_full_url, '[?&]{name}=([^&]+)', 1), '')"


PARAMS = """
  SELECT event_id, event_time, initial_referrer_host AS ref, """ + ", ".join(
    f"{param(n)} AS {n}" for n in ("utm_source", "utm_medium", "utm_campaign", "gclid", "fbclid", "cmpid")
) + " FROM fx_source_properties"


def traffic(strict: bool = False) -> str:
    ref = "ref" if strict else "nullif(ref, '')"
    return f"""
      SELECT event_id,
        CASE WHEN coalesce(gclid, fbclid) IS NOT NULL THEN 'cpc' ELSE coalesce(utm_medium,
          CASE WHEN regexp_matches(ref, '(google|bing)[.]', 'i') THEN 'organic' WHEN length(ref) > 0 THEN 'referral' END,
          'direct') END AS medium,
        coalesce(if(gclid IS NULL, NULL, 'google'), if(fbclid IS NULL, NULL, 'facebook'), utm_source, {ref}, 'direct') AS source,
        coalesce(utm_campaign, cmpid, 'organic/untracked') AS campaign
      FROM params"""


IDENTITY = "SELECT id AS device_id, uid FROM fx_users WHERE uid IS NOT NULL"


def touchpoints(lookback: int = 90, window: int = 14) -> str:
    return f"""
      SELECT user_id, session_id, best.at AS event_time, date_trunc('week', best.at) AS week, best.source, best.medium, best.campaign
      FROM (
        SELECT coalesce(i.uid, e.user_id) AS user_id, e.session_id, min({{
          'rank': CASE t.medium WHEN 'direct' THEN 3 WHEN 'organic' THEN 2 WHEN 'referral' THEN 2 ELSE 1 END,
          'at': e.event_time, 'id': e.id, 'source': t.source, 'medium': t.medium, 'campaign': t.campaign}}) AS best
        FROM fx_events e JOIN traffic t ON e.id = t.event_id LEFT JOIN identity i ON e.user_id = i.device_id
        WHERE e.event_time >= {AS_OF} - INTERVAL {lookback + window} DAY GROUP BY 1, 2) x"""


def conversions(lookback: int = 90, scale: int = 2) -> str:
    return f"""
      SELECT user_id, conversion_session_id, converted_at, conversion_revenue,
             lag(converted_at) OVER w AS previous_conversion_at, row_number() OVER w AS conversion_index
      FROM (SELECT coalesce(i.uid, ce.user_id) AS user_id, ce.session_id AS conversion_session_id,
                   ce.event_time AS converted_at, ce.event_id,
                   cast(try_cast(json_extract_string(ce.event_properties, '$.price') AS decimal(38,{scale})) AS double)
                     AS conversion_revenue
            FROM fx_custom_events ce LEFT JOIN identity i ON ce.user_id = i.device_id
            WHERE ce.event_name = 'Checkout Success' AND ce.event_time >= {AS_OF} - INTERVAL {lookback} DAY) c
      WINDOW w AS (PARTITION BY user_id ORDER BY converted_at, event_id)"""


def linked(window: int = 14) -> str:
    return f"""
      SELECT t.user_id, t.session_id, t.event_time AS session_start_time, t.source, t.medium, t.campaign,
             c.converted_at, c.conversion_revenue, c.conversion_index
      FROM tp t JOIN (SELECT *, greatest(previous_conversion_at, converted_at - INTERVAL {window} DAY) AS opens FROM cv) c
        ON c.user_id = t.user_id AND t.event_time >= c.opens AND t.event_time < c.converted_at"""


PATHS = """
  SELECT *, session_number = total_sessions_for_conversion AS is_conversion_session FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, converted_at ORDER BY session_start_time, session_id) AS session_number,
           count(session_id) OVER (PARTITION BY user_id, converted_at) AS total_sessions_for_conversion
    FROM linked) p"""

SHARES = """
  SELECT *, if(session_number = 1, conversion_revenue, 0.0) AS ft, if(is_conversion_session, conversion_revenue, 0.0) AS lt,
    (1.0::double / total_sessions_for_conversion) * conversion_revenue AS ln,
    CASE total_sessions_for_conversion WHEN 1 THEN 1.0::double WHEN 2 THEN 0.5::double
      ELSE if(session_number = 1 OR is_conversion_session, 0.4::double, 0.2::double / (total_sessions_for_conversion - 2))
    END * conversion_revenue AS us
  FROM paths"""

_IDS = ("user_id, session_id, session_start_time, converted_at, source, medium, campaign, "
        "total_sessions_for_conversion, session_number, is_conversion_session")

FULL = """
  SELECT user_id, max(session_id) AS session_id, max(session_start_time) AS session_start_time, converted_at, source,
         medium, campaign, max(total_sessions_for_conversion) AS total_sessions_for_conversion,
         max(session_number) AS session_number, bool_or(is_conversion_session) AS is_conversion_session,
         'Full Credit' AS attribution_model, conversion_revenue AS attributed_revenue, conversion_index
  FROM shares GROUP BY user_id, source, medium, campaign, converted_at, conversion_revenue, conversion_index"""

# Table aliases keep the shared CTE names apart from column names.
MODEL_COLUMNS = {"First Touch": "ft", "Last Touch": "lt", "Linear": "ln", "40-20-40 U-Shaped": "us"}

MART = " UNION ALL ".join(
    f"SELECT {_IDS}, '{m}' AS attribution_model, {col} AS attributed_revenue, conversion_index FROM shares WHERE {col} > 0"
    for m, col in MODEL_COLUMNS.items()
) + f" UNION ALL SELECT {_IDS}, attribution_model, attributed_revenue, conversion_index FROM fullcredit"


def pipeline(lookback: int = 90, window: int = 14, scale: int = 2, strict: bool = False) -> dict[str, str]:
    return {
        "params": PARAMS, "traffic": traffic(strict), "identity": IDENTITY,
        "tp": touchpoints(lookback, window), "cv": conversions(lookback, scale),
        "linked": linked(window), "paths": PATHS, "shares": SHARES, "fullcredit": FULL, "mart": MART,
        "broken": BROKEN,
    }


def _pick(n: int) -> str:
    return f"((length(session_id) + conversion_index * 7 + day(session_start_time)) % {n})"


BROKEN = f"""
  SELECT user_id, session_id,
    CASE WHEN attribution_model = 'Linear' AND {_pick(17)} = 4 THEN converted_at ELSE session_start_time END AS session_start_time,
    converted_at, CASE WHEN {_pick(19)} = 1 THEN NULL ELSE source END AS source,
    CASE WHEN {_pick(23)} = 1 THEN NULL ELSE medium END AS medium, campaign, total_sessions_for_conversion,
    CASE WHEN attribution_model = 'Linear' AND {_pick(5)} = 1 THEN session_number - 1
         WHEN attribution_model = 'Linear' AND {_pick(5)} = 2 THEN session_number + 1 ELSE session_number END AS session_number,
    is_conversion_session,
    CASE WHEN attribution_model = 'Full Credit' AND {_pick(29)} = 5 THEN 'Half Credit' ELSE attribution_model END AS attribution_model,
    CASE WHEN {_pick(31)} = 6 THEN -attributed_revenue ELSE attributed_revenue END AS attributed_revenue, conversion_index
  FROM (SELECT * FROM mart WHERE NOT (attribution_model = 'Last Touch' AND {_pick(11)} = 3)
        UNION ALL SELECT * FROM mart WHERE attribution_model = 'First Touch' AND {_pick(13)} = 2) m"""


def revenue_check(table: str) -> str:
    return f"""
      SELECT a.user_id, a.converted_at, a.conversion_index, a.attribution_model AS model_a, a.r AS revenue_a,
             b.attribution_model AS model_b, b.r AS revenue_b, 'Revenue mismatch between models' AS assertion
      FROM sums a JOIN sums b ON a.user_id = b.user_id AND a.converted_at = b.converted_at
       AND a.conversion_index = b.conversion_index AND a.attribution_model < b.attribution_model
      WHERE abs(a.r - b.r) > 0.01""".replace("sums", f"""(
        SELECT user_id, converted_at, conversion_index, attribution_model, round(sum(attributed_revenue), 2) AS r
        FROM {table} WHERE attribution_model IN ('First Touch', 'Last Touch', 'Linear', '40-20-40 U-Shaped') GROUP BY ALL)""")


MOMENT = "strftime(converted_at, '%Y-%m-%d %H:%M:%S')"


def ordering_check(table: str) -> str:
    lin = f"(SELECT * FROM {table} WHERE attribution_model = 'Linear')"
    stats = f"""(SELECT user_id, converted_at, conversion_index, min(session_number) AS lo, max(session_number) AS hi,
                 max(total_sessions_for_conversion) AS d FROM {lin} l GROUP BY ALL)"""
    return f"""
      SELECT user_id, session_id AS context, 'session_start_time >= converted_at' AS assertion FROM {lin} a
      WHERE session_start_time >= converted_at
      UNION ALL SELECT user_id, {MOMENT}, 'min(session_number)=' || lo || ', expected 1' FROM {stats} b WHERE lo <> 1
      UNION ALL SELECT user_id, {MOMENT}, 'max(session_number)=' || hi || ' but total_sessions_for_conversion=' || d
      FROM {stats} c WHERE hi <> d
      UNION ALL SELECT user_id, session_id, 'session_number=' || session_number || ' > total_sessions=' || total_sessions_for_conversion
      FROM {lin} e WHERE session_number > total_sessions_for_conversion"""


def completeness_check(table: str) -> str:
    return f"""
      SELECT user_id, {MOMENT} AS context, 'only ' || n || ' of 5 attribution models present' AS assertion
      FROM (SELECT user_id, converted_at, conversion_index, count(DISTINCT attribution_model) AS n FROM {table} GROUP BY ALL) a
      WHERE n <> 5
      UNION ALL SELECT user_id, session_id, 'duplicate row for model=' || attribution_model || ' converted_at=' || {MOMENT}
      FROM {table} GROUP BY user_id, session_id, converted_at, attribution_model HAVING count(*) > 1
      UNION ALL SELECT user_id, session_id, 'unexpected attribution_model value: "' || attribution_model || '"'
      FROM {table} WHERE attribution_model NOT IN ('First Touch', 'Last Touch', 'Linear', '40-20-40 U-Shaped', 'Full Credit')"""


def value_check(table: str, medium: str = "medium") -> str:
    flag = "CASE WHEN is_conversion_session THEN 'true' ELSE 'false' END"
    return f"""
      SELECT user_id, session_id AS context,
             'attributed_revenue is negative: ' || cast(cast(attributed_revenue AS decimal(38,2)) AS varchar) AS assertion
      FROM {table} WHERE attributed_revenue < 0
      UNION ALL SELECT user_id, session_id, 'session_number < 1: ' || session_number FROM {table} WHERE session_number < 1
      UNION ALL SELECT user_id, session_id, 'total_sessions_for_conversion < 1: ' || total_sessions_for_conversion
      FROM {table} WHERE total_sessions_for_conversion < 1
      UNION ALL SELECT user_id, session_id, 'medium is NULL' FROM {table} WHERE medium IS NULL
      UNION ALL SELECT user_id, session_id, 'source is NULL' FROM {table} WHERE source IS NULL
      UNION ALL SELECT user_id, session_id, 'is_conversion_session flag inconsistent: flag=' || {flag} || ' session_number='
        || session_number || ' total=' || total_sessions_for_conversion
      FROM {table} WHERE is_conversion_session <> (session_number = total_sessions_for_conversion)
      UNION ALL SELECT user_id, session_id, 'medium is NULL in touchpoints' FROM tp WHERE {medium} IS NULL
      UNION ALL SELECT user_id, session_id, 'source is NULL in touchpoints' FROM tp WHERE source IS NULL"""


MART_OUT = f"{_IDS}, attribution_model, round(attributed_revenue, 6) AS attributed_revenue"


def parity() -> dict[str, str]:
    every = "event_time IS NOT NULL"
    plain = _parity(every)
    # The same questions over tables in another layout.
    return {**plain, **{f"{name}_colocated": plain[name] for name in ("k01_sessions_by_page", "k05_funnel_first_touch")},
            "k07_touchpoints_colocated": with_fx("SELECT * FROM tp", pipeline())}


def _parity(every: str) -> dict[str, str]:
    return {
        "k01_sessions_by_page": with_fx(f"""
          SELECT count(DISTINCT e.session_id) AS sessions FROM fx_events e JOIN fx_source_properties sp ON e.id = sp.event_id
          LEFT JOIN fx_page_definitions pd ON sp.page_definition_id = pd.id
          WHERE pd.name = '404 Page' AND {LOCAL_DAY.replace('event_time', 'e.event_time')}"""),
        "k02_device_and_identified_counts": with_fx(f"""
          SELECT count(DISTINCT user_id) AS cnt_user_id, count(DISTINCT uid) AS cnt_uid
          FROM fx_events e JOIN fx_users u ON e.user_id = u.id WHERE {LOCAL_DAY}"""),
        "k03_ui_user_count": with_fx(f"""
          SELECT count(DISTINCT coalesce(uid, user_id)) AS cnt_users FROM (
            SELECT session_id, max(e.user_id) AS user_id, max(u.uid) AS uid
            FROM fx_events e JOIN fx_users u ON e.user_id = u.id WHERE {LOCAL_DAY} GROUP BY session_id) s"""),
        "k04_property_id_count": with_fx(f"""
          SELECT count(DISTINCT up.enterprise_id) AS cnt_property_ids
          FROM fx_events e JOIN fx_user_properties up ON e.user_id = up.user_id
          WHERE up.enterprise_id IS NOT NULL AND {LOCAL_DAY}"""),
        "k05_funnel_first_touch": with_fx(FIRST_TOUCH_FUNNEL, {"hits": funnel_hits(every)}),
        "k05_funnel_first_touch_local_day": with_fx(FIRST_TOUCH_FUNNEL, {"hits": funnel_hits(LOCAL_DAY)}),
        "k05_funnel_first_touch_week": with_fx(FIRST_TOUCH_FUNNEL, {"hits": funnel_hits(
            f"event_time >= {AS_OF} - INTERVAL 7 DAY AND event_time < {AS_OF}")}),
        "k06_funnel_repeated_page": with_fx(chained_funnel(3), {"hits": funnel_hits(every, BACK_TO_SEARCH)}),
        "k06_funnel_chained": with_fx(chained_funnel(), {"hits": funnel_hits(every)}),
        "k06_funnel_chained_local_day": with_fx(chained_funnel(), {"hits": funnel_hits(LOCAL_DAY)}),
    }


def attribution() -> dict[str, str]:
    p = pipeline()
    short = pipeline(10, 7)
    mart = lambda where="": with_fx(f"SELECT {MART_OUT} FROM mart {where}", p)
    only = lambda m: mart(f"WHERE attribution_model = '{m}'")
    return {
        "k07_touchpoints": with_fx("SELECT * FROM tp", p),
        "k07_touchpoints_short_lookback": with_fx("SELECT * FROM tp", short),
        "k07a_traffic_classes": with_fx("SELECT event_id, source, medium, campaign FROM traffic", p),
        "k07a_traffic_classes_strict": with_fx(
            "SELECT source, medium, campaign, count(*) AS events FROM traffic GROUP BY ALL", pipeline(strict=True)),
        "k07b_url_parameters": with_fx(
            "SELECT event_id, utm_source, utm_medium, utm_campaign, gclid, fbclid, cmpid FROM params", p),
        "k08_conversions": with_fx("SELECT * FROM cv", p),
        "k08_conversions_short_integer_price": with_fx("SELECT * FROM cv", pipeline(10, 7, 0)),
        "k09_attributed_sessions": with_fx("SELECT * EXCLUDE (conversion_index) FROM linked", p),
        "j9_interval_join": with_fx("SELECT * EXCLUDE (conversion_index) FROM linked", p),
        "k10_path_metadata": with_fx("SELECT * EXCLUDE (conversion_index) FROM paths", p),
        "k11_first_touch": only("First Touch"),
        "k12_last_touch": only("Last Touch"),
        "k13_linear": only("Linear"),
        "k14_u_shaped": only("40-20-40 U-Shaped"),
        "k15_full_credit": only("Full Credit"),
        "k15_full_credit_latest": with_fx(f"""
          SELECT {_IDS}, 'Full Credit' AS attribution_model, conversion_revenue AS attributed_revenue FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, source, medium, campaign, converted_at, conversion_revenue
                                         ORDER BY session_number DESC) AS rn FROM shares) x WHERE rn = 1""", p),
        "k16_attribution_mart": mart(),
        "k16_attribution_mart_short_windows": with_fx(f"SELECT {MART_OUT} FROM mart", short),
        "k17_revenue_integrity": with_fx(revenue_check("mart"), p),
        "k17_revenue_integrity_broken": with_fx(revenue_check("broken"), p),
        "k18_session_ordering": with_fx(ordering_check("mart"), p),
        "k18_session_ordering_broken": with_fx(ordering_check("broken"), p),
        "k19_completeness": with_fx(completeness_check("mart"), p),
        "k19_completeness_broken": with_fx(completeness_check("broken"), p),
        "k20_value_integrity": with_fx(value_check("mart"), p),
        "k20_value_integrity_broken": with_fx(value_check("broken", "nullif(medium, 'direct')"), p),
        "k26_channel_performance": with_fx("""
          SELECT attribution_model, source, medium, campaign, date_trunc('week', converted_at) AS week,
                 count(DISTINCT (user_id, converted_at)) AS conversions, round(sum(attributed_revenue), 6) AS revenue
          FROM mart GROUP BY ALL""", p),
    }


def staging() -> dict[str, str]:
    return {
        "s4_stage_events": with_fx("""
          SELECT id AS event_id, user_id AS device_id, session_id, event_time, event_type, processed_time FROM fx_events"""),
        "s5_stage_source_properties": with_fx("""
          SELECT event_id, url_full_url AS full_url, url_query, url_path, initial_referrer_host AS referrer_host,
                 initial_referrer_full_url FROM fx_source_properties"""),
        "s6_stage_users": with_fx("SELECT id AS device_id, uid AS user_id FROM fx_users WHERE uid IS NOT NULL"),
        "s7_stage_custom_events": with_fx("""
          SELECT event_id, user_id AS device_id, session_id, event_time, event_name, event_properties,
                 cast(try_cast(json_extract_string(event_properties, '$.price') AS decimal(38,2)) AS double) AS price
          FROM fx_custom_events"""),
    }
