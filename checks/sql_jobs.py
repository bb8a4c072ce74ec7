"""Oracle SQL for exports, property profiles, refresh and streams."""

from __future__ import annotations

from checks.fx import with_fx
from checks.sql_attribution import FIRST_TOUCH_FUNNEL, MART_OUT, _IDS, funnel_hits, pipeline

EXPORTABLE = "SELECT uid, loyalty_tier, updated_at FROM fx_export_users WHERE uid IS NOT NULL AND uid <> ''"


def outbox(rows: str, properties: str, size: int = 100) -> str:
    """Payload per chunk of ``size`` rows in (updated_at, uid) order."""
    return f"""
      SELECT n // {size} AS chunk_id, count(*) AS users, max(updated_at) AS updated_at, max_by(uid, n) AS uid,
             '{{"requests":[' || string_agg('{{"uid":"' || uid || '","properties":' || {properties} || '}}', ',' ORDER BY n) || ']}}' AS payload
      FROM (SELECT *, row_number() OVER (ORDER BY updated_at, uid) - 1 AS n FROM ({rows}) r) o GROUP BY 1"""


def exports() -> dict[str, str]:
    tier = """'{"loyalty_tier":"' || loyalty_tier || '","warehouse_synced_at":"' || strftime(updated_at, '%Y-%m-%d %H:%M:%S') || '"}'"""
    bag = """'{"warehouse_synced":true,"cohort":"spring","warehouse_synced_at":"2024-01-30"}'"""
    sample = "SELECT uid, NULL::timestamp AS updated_at FROM fx_export_users WHERE uid <> '' ORDER BY uid LIMIT 250"
    prof = lambda table, col, kind: (
        f"SELECT '{table}' AS table_name, '{col}' AS column_name, '{kind}' AS data_type, count({col}) AS non_null_count, "
        f"count(DISTINCT {col}) AS approx_distinct FROM fx_{table}")
    profile = " UNION ALL ".join([
        prof("user_properties", "enterprise_id", "string"), prof("user_properties", "loyalty_tier", "string"),
        prof("user_properties", "home_region", "int"), prof("page_properties", "session_id", "string"),
        prof("page_properties", "user_id", "string"), prof("page_properties", "product_category", "string"),
        prof("page_properties", "price_cents", "bigint"), prof("element_properties", "button_color", "string"),
        prof("element_properties", "slot", "int")])
    chunks = outbox(EXPORTABLE, tier)
    epoch = "timestamp '1970-01-01 00:00:00'"
    # The refused chunk is the first holding a change from 2001; the first run delivers those before it.
    failed = f"""
      WITH box AS ({chunks}), stop AS (
        SELECT min(chunk_id) AS c, (SELECT max(chunk_id) FROM box) AS top FROM box WHERE payload LIKE '%"warehouse_synced_at":"2001-%'),
      done AS (SELECT count(*) AS n, coalesce(sum(users), 0) AS u, max(updated_at) AS upto FROM box, stop WHERE chunk_id < c),
      rest AS (SELECT count(*) AS n, sum(users) AS u, max(updated_at) AS upto FROM box, stop WHERE chunk_id >= c)
      SELECT 1 AS run, CASE WHEN c = top AND (SELECT users FROM box WHERE chunk_id = top) < 100 THEN 'failed_on_final_chunk'
               ELSE 'failed_mid_run' END AS status, n AS chunks_pushed, cast(u AS bigint) AS users_pushed, {epoch} AS previous_watermark,
             coalesce(upto, {epoch}) AS new_watermark, 503 AS http_status, 'unavailable' AS response FROM done, stop
      UNION ALL SELECT 2, 'ok', rest.n, cast(rest.u AS bigint), coalesce(done.upto, {epoch}), rest.upto, 0, '' FROM rest, done"""
    return {
        "s14_sync_state": with_fx(f"""
          SELECT DISTINCT loyalty_tier AS sync_name, CASE WHEN loyalty_tier = (SELECT min(loyalty_tier) FROM fx_user_properties)
            THEN (SELECT max(updated_at) FROM fx_export_users) ELSE {epoch} END AS last_synced_at FROM fx_user_properties"""),
        "r6_high_watermark_delta": with_fx(
            f"{EXPORTABLE} AND (updated_at, uid) > (timestamp '2001-01-01 00:00:00', 'c3')"),
        "r7_ordered_chunks": with_fx(
            f"SELECT uid, n, n // 1000 AS chunk_id FROM (SELECT uid, row_number() OVER (ORDER BY updated_at, uid) - 1 AS n FROM ({EXPORTABLE}) r) o"),
        "k22_property_profile": with_fx(profile),
        "k22_property_profile_estimates": with_fx(f"SELECT * EXCLUDE (approx_distinct), true AS close FROM ({profile}) p"),
        "k23_one_time_export": with_fx(f"""
          SELECT chunk_id, users, payload, 'ok' AS status, cast(sum(users) OVER () AS bigint) AS users_pushed FROM ({outbox(sample, bag)}) b"""),
        "k24_incremental_export_outbox": with_fx(f"SELECT * FROM ({chunks}) b"),
        "k24_incremental_export_report": with_fx(f"""
          SELECT 'ok' AS status, count(*) AS chunks_pushed, cast(sum(users) AS bigint) AS users_pushed, {epoch} AS previous_watermark,
                 max(updated_at) AS new_watermark FROM ({chunks}) b"""),
        "k24_incremental_export_failed_and_resumed": with_fx(f"SELECT * FROM ({failed}) f"),
    }


def early_mart() -> str:
    """The mart as it stood before the second batch: early rows, fewer identities."""
    p = pipeline()
    cut = "timestamp '2024-01-24 00:00:00'"
    text = with_fx("SELECT * EXCLUDE (conversion_index) FROM mart", {**p,
        "identity": "SELECT id AS device_id, uid FROM fx_users WHERE uid IS NOT NULL AND id NOT LIKE '%7'"})
    return text.replace("FROM fx_events e JOIN traffic", f"FROM (SELECT * FROM fx_events WHERE event_time < {cut}) e JOIN traffic").replace(
        "FROM fx_custom_events ce LEFT", f"FROM (SELECT * FROM fx_custom_events WHERE event_time < {cut}) ce LEFT")


def refresh() -> dict[str, str]:
    p = pipeline()
    now = with_fx("SELECT * EXCLUDE (conversion_index) FROM mart", p)
    keys = f"{_IDS}, attribution_model, attributed_revenue"
    report = f"""
      SELECT cast(coalesce(sum(greatest(n - o, 0)), 0) AS bigint) AS inserted_rows, cast(coalesce(sum(greatest(o - n, 0)), 0) AS bigint) AS deleted_rows,
             cast(coalesce(sum(least(o, n)), 0) AS bigint) AS unchanged_rows FROM (
        SELECT {keys}, sum(o) AS o, sum(n) AS n FROM (
          SELECT {keys}, 1 AS o, 0 AS n FROM ({early_mart()}) a UNION ALL SELECT {keys}, 0, 1 FROM ({now}) b) u GROUP BY ALL) g"""
    per_day = lambda base, select, width, slide: with_fx(f"""
      SELECT window_start, window_start + INTERVAL {width} HOUR AS window_end, {select} FROM (
        SELECT time_bucket(INTERVAL {slide} HOUR, event_time, timestamp '2024-01-01 00:00:00') - INTERVAL (s * {slide}) HOUR AS window_start, b.*
        FROM fx_{base} b, range({width // slide}) r(s)) w GROUP BY 1""")
    mart = with_fx(f"SELECT {MART_OUT} FROM mart", p)
    return {
        "r1_incremental_touchpoints": with_fx("SELECT * FROM tp", p),
        "r2_incremental_conversions": with_fx("SELECT * FROM cv", p),
        "r3_incremental_mart": mart,
        "r4_mart_with_user_changes": mart,
        "k25_refresh_report": report,
        "rs1_streaming_touchpoints": with_fx("SELECT * EXCLUDE (week) FROM tp", p),
        "rs2_streaming_conversions": with_fx("SELECT * FROM cv", p),
        "rs2_stateful_conversions": with_fx("SELECT * FROM cv", p),
        "rs2_streaming_mart": mart,
        "rs3_streaming_interval_join": with_fx("SELECT * EXCLUDE (conversion_index) FROM linked", p),
        "rs4_streaming_funnel": with_fx(FIRST_TOUCH_FUNNEL, {"hits": funnel_hits("event_time IS NOT NULL")}),
        "rs5_streaming_daily_metrics": per_day("clicks", "count(*) AS click_count, cast(sum(fs_rage_count) AS bigint) AS rage_click_count", 24, 24),
        "rs5_streaming_sliding_metrics": per_day(
            "loads", "round(avg(largest_paint_time_millis), 6) AS avg_lcp, count(*) AS load_event_count", 6, 3),
        "rs5_visitor_sketches": with_fx("""
          SELECT * FROM (WITH e AS (SELECT DISTINCT user_id, cast(event_time AS date) AS d FROM fx_events),
          spread AS (
            SELECT 'week' AS kind, cast(date_trunc('week', d) AS date) AS period, user_id FROM e
            UNION ALL SELECT 'month', cast(date_trunc('month', d) AS date), user_id FROM e
            UNION ALL SELECT '7 days', d + cast(i AS integer), user_id FROM e, range(7) r(i))
          SELECT kind, cast(period AS varchar) AS period, count(DISTINCT user_id) AS visitors, true AS close FROM spread GROUP BY kind, period) v"""),
    }
