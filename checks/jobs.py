"""Exports, property profiles, incremental refresh and streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.attribution import stored
from checks.common import CFG, Build
from checks.parity import hits
from trailmark.config import work_path, work_table
from trailmark.functions.traffic import signal_rank
from trailmark.operators import conversions, export, funnel, properties, sketches, touchpoints
from trailmark.plans.refresh import AttributionStore
from trailmark.sources.landing import Star, export_users
from trailmark.sources.state import Cursor, SyncState
from trailmark.streaming import jobs, stateful

SPLIT = "2024-01-24 00:00:00"
FILES_PER_ARRIVAL = 4
_ACCEPT = lambda payload: (200, "ok")


def _reject_late(payload: str) -> tuple[int, str]:
    """Refuses a batch that carries changes made in 2001 or later."""
    return (503, "unavailable") if '"warehouse_synced_at":"2001-' in payload else (200, "ok")


def _state(t: Star) -> SyncState:
    return SyncState(t.spark, work_path(t.spark, "state"))


def k23(t: Star) -> DataFrame:
    """Outbox of the one-time export, users unpacked."""
    bag = {"warehouse_synced": True, "cohort": "spring", "warehouse_synced_at": "2024-01-30"}
    report, outbox = export.export_user_properties(export_users(t.spark, t.sf_dir), 250, bag, batch_size=100)
    done = report.first()
    return outbox.withColumns({"status": F.lit(done["status"]), "users_pushed": F.lit(done["users_pushed"])})


def k24_outbox(t: Star) -> DataFrame:
    _, outbox = export.export_updated_user_properties(export_users(t.spark, t.sf_dir), _state(t), batch_size=100)
    return outbox


def k24_report(t: Star) -> DataFrame:
    report, _ = export.export_updated_user_properties(
        export_users(t.spark, t.sf_dir), _state(t), batch_size=100, transport=_ACCEPT)
    return report.drop("http_status", "response")


def k24_failed(t: Star) -> DataFrame:
    """Two runs: the first stops at a refused chunk, the second finishes."""
    state, users = _state(t), export_users(t.spark, t.sf_dir)
    first, _ = export.export_updated_user_properties(users, state, batch_size=100, transport=_reject_late, wave=4)
    second, _ = export.export_updated_user_properties(users, state, batch_size=100, transport=_ACCEPT, wave=4)
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2))).fillna(
        {"http_status": 0, "response": ""})


def r06(t: Star) -> DataFrame:
    return export.after_cursor(export.exportable(export_users(t.spark, t.sf_dir)), Cursor("2001-01-01 00:00:00", "c3"))


def r07(t: Star) -> DataFrame:
    rows = export.exportable(export_users(t.spark, t.sf_dir))
    return export.numbered_in_order(rows, ["updated_at", "uid"], "n").select(
        "uid", "n", F.floor(F.col("n") / 1000).alias("chunk_id"))


def s14(t: Star) -> DataFrame:
    """State table after seeding one sync per loyalty tier twice, around an advance."""
    state = _state(t)
    tiers = t["user_properties"].select(F.col("loyalty_tier").alias("sync_name"))
    state.seed_all(tiers)
    newest = export_users(t.spark, t.sf_dir).agg(F.max("updated_at").cast("string")).first()[0]
    state.advance(tiers.agg(F.min("sync_name")).first()[0], Cursor(newest, "c1"))
    state.seed_all(tiers)
    return state.table().select("sync_name", "last_synced_at")


def k22(t: Star) -> DataFrame:
    return properties.property_profile({n: t[n] for n in properties.RESERVED}, exact=True)


def k22_approx(t: Star) -> DataFrame:
    """Estimated distinct counts, checked against the exact ones to within 10 percent."""
    by = ["table_name", "column_name"]
    approx = properties.property_profile({n: t[n] for n in properties.RESERVED}).withColumnRenamed("approx_distinct", "estimate")
    close = F.abs(F.col("estimate") - F.col("approx_distinct")) <= F.greatest(F.lit(1.0), 0.1 * F.col("approx_distinct"))
    return approx.join(k22(t).select(*by, "approx_distinct"), by).select(
        *by, "data_type", "non_null_count", close.alias("close"))


_STORES: dict[tuple[str, str, str], tuple[AttributionStore, DataFrame]] = {}


def once(t: Star, kind: str, build: Callable[[Star], tuple[AttributionStore, DataFrame]]):
    """The stored tables of one kind, built once per application: several queries read them."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, kind)
    if key not in _STORES:
        _STORES[key] = build(t)
    return _STORES[key]


def two_batches(t: Star) -> tuple[AttributionStore, DataFrame]:
    return once(t, "batches", store_in_two_batches)


def store_in_two_batches(t: Star) -> tuple[AttributionStore, DataFrame]:
    store = AttributionStore(t.spark, work_path(t.spark, "store"), CFG, buckets=8)
    early, late = F.col("event_time") < SPLIT, F.col("event_time") >= SPLIT
    # Devices with an id ending in 7 are identified only by the second batch.
    unknown = t["users"].withColumn("uid", F.when(~F.col("id").endswith("7"), F.col("uid")))
    store.refresh(t["events"].filter(early), t["source_properties"], t["custom_events"].filter(early), unknown)
    report = store.refresh(t["events"].filter(late), t["source_properties"], t["custom_events"].filter(late), t["users"])
    return store, report


def store_by_cursor(t: Star) -> tuple[AttributionStore, DataFrame]:
    """Users come as changes: some devices are identified late, some wrongly at first, some only for a while."""
    store = AttributionStore(t.spark, work_path(t.spark, "store"), CFG, buckets=8, users_by_cursor=True)
    early, late = F.col("event_time") < SPLIT, F.col("event_time") >= SPLIT
    ends = lambda digit: F.col("id").endswith(digit)
    at = F.col("last_updated_time")
    first = t["users"].withColumns({
        "uid": F.when(ends("7"), F.lit(None)).when(ends("5"), F.lit("nobody")).when(ends("3") & F.col("uid").isNull(), F.lit("guest")).otherwise(F.col("uid")),
        "deleted": F.lit(False)})
    moved = ends("7") | ends("5") | ends("3")
    gone = ends("3") & F.col("uid").isNull()
    second = t["users"].withColumns({
        "last_updated_time": F.when(moved, F.greatest(at, F.lit("2030-01-01").cast("timestamp"))).otherwise(at),
        "uid": F.when(gone, F.lit("guest")).otherwise(F.col("uid")), "deleted": gone})
    store.refresh(t["events"].filter(early), t["source_properties"], t["custom_events"].filter(early), first)
    report = store.refresh(t["events"].filter(late), t["source_properties"], t["custom_events"].filter(late), second)
    store.vacuum(keep=1)
    return store, report


def streamed(t: Star) -> AttributionStore:
    return once(t, "stream", lambda x: (streamed_store(x), x.base))[0]


def streamed_store(t: Star) -> AttributionStore:
    store = AttributionStore(t.spark, work_path(t.spark, "store"), CFG, buckets=8)
    source = work_path(t.spark, "arrivals")
    day = F.dayofmonth("event_time")
    for cond in (day <= 12, (day > 12) & (day <= 22), day > 22):
        t["events"].filter(cond).repartition(FILES_PER_ARRIVAL).write.mode("append").parquet(source)
    stream = t.spark.readStream.schema(t["events"].schema).option("maxFilesPerTrigger", FILES_PER_ARRIVAL).parquet(source)

    def inputs(batch: DataFrame):
        new = t["custom_events"].join(batch.select(F.col("id").alias("event_id")), "event_id", "left_semi")
        return t["source_properties"], new, t["users"]

    q = jobs.refresh_on_arrival(stream, store, inputs, work_path(t.spark, "checkpoint"), {"availableNow": True})
    q.awaitTermination()
    return store


def rs2_stateful(t: Star) -> DataFrame:
    """Conversions in shuffled arrivals, put in order by state per user; a last row of a user of its own moves the watermark past all."""
    columns = ["user_id", "conversion_session_id", "converted_at", "conversion_revenue", "event_id"]
    # Written once: the arrivals are read from it four times.
    found = work_table(touchpoints.with_identity(conversions.device_conversions(t["custom_events"], CFG), t["users"]).select(*columns), "identified-conversions")
    path = work_path(t.spark, "arrivals")
    for i in range(3):
        found.filter(F.pmod(F.hash("event_id"), F.lit(3)) == i).repartition(FILES_PER_ARRIVAL).write.mode("append").parquet(path)
    end = found.limit(1).select(F.lit("\x7fend").alias("user_id"), *columns[1:2], F.lit("2030-01-01").cast("timestamp").alias("converted_at"), *columns[3:])
    end.coalesce(1).write.mode("append").parquet(path)
    stateful.use_rocksdb(t.spark)
    try:
        stream = t.spark.readStream.schema(found.schema).option("maxFilesPerTrigger", FILES_PER_ARRIVAL).parquet(path)
        ordered = stateful.conversions_in_order(stream, "40 days")
        out = work_path(t.spark, "ordered")
        q = (ordered.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", work_path(t.spark, "checkpoint")).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        t.spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    rows = t.spark.read.schema(ordered.schema).parquet(out).filter(F.col("user_id") != "\x7fend")
    return rows.filter(~F.col("late")).select(*conversions.COLUMNS)


def _arrivals(t: Star, df: DataFrame, time: str) -> DataFrame:
    """``df`` as a stream of three time-ordered arrivals of several files each."""
    path = work_path(t.spark, "arrivals")
    day = F.dayofmonth(time)
    for cond in (day <= 10, (day > 10) & (day <= 20), day > 20):
        df.filter(cond).repartition(FILES_PER_ARRIVAL).write.mode("append").parquet(path)
    return t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", FILES_PER_ARRIVAL).parquet(path)


def _drain(t: Star, stream: DataFrame, keys: list[str]) -> DataFrame:
    log = work_path(t.spark, "updates")
    jobs.append_updates(stream, log, work_path(t.spark, "checkpoint"), {"availableNow": True}, keys, fold_every=2).awaitTermination()
    return jobs.latest(t.spark, log, keys, stream.schema)


def rs1(t: Star) -> DataFrame:
    rows = touchpoints.with_identity(touchpoints.classified_events(t["events"], t["source_properties"], CFG), t["users"])
    signals = rows.select("user_id", "session_id", "event_time", "event_id", "source", "medium", "campaign",
                          signal_rank(F.col("medium")).alias("rank"))
    stream = jobs.best_signal_per_session(_arrivals(t, signals, "event_time"), "40 days")
    return jobs.best_of_slices(_drain(t, stream, ["session_id", "user_id", "slice"]))


def rs3(t: Star) -> DataFrame:
    tp, cv = stored(t)
    linked = jobs.link_touchpoints(_arrivals(t, tp, "event_time"), _arrivals(t, cv, "converted_at"), CFG, "40 days")
    out = work_path(t.spark, "linked")
    q = (linked.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", work_path(t.spark, "checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    return t.spark.read.schema(linked.schema).parquet(out)


def rs4(t: Star) -> DataFrame:
    stream = jobs.running_funnel(_arrivals(t, hits(t), "event_time"), 5, "40 days")
    slices = _drain(t, stream, ["user_id", "session_id", "slice"])
    times = jobs.first_of_slices(slices, 5).filter(F.col("stp1_time").isNotNull())
    flags = funnel.reached(5)
    counted = times.agg(F.countDistinct("session_id").alias("stp1_sessions"),
                        *[F.count_if(f).alias(f"stp{i}_sessions") for i, f in enumerate(flags, 2)])
    return funnel.with_rates(counted, 5)


def rs5(t: Star) -> DataFrame:
    stream = jobs.windowed_metrics(_arrivals(t, t["clicks"], "event_time"), ["click_count", "rage_click_count"],
                                   "1 day", None, "40 days")
    return _drain(t, stream, ["window_start", "window_end"])


def rs5_sliding(t: Star) -> DataFrame:
    stream = jobs.windowed_metrics(_arrivals(t, t["loads"], "event_time"), ["avg_lcp", "load_event_count"],
                                   "6 hours", "3 hours", "40 days")
    return _drain(t, stream, ["window_start", "window_end"])


def rs5_sketches(t: Star) -> DataFrame:
    """Devices by week, month and seven-day window from day sketches kept by a stream, checked against the exact counts."""
    path = work_path(t.spark, "sketches")
    events = t["events"].select("user_id", "event_time")
    jobs.sketch_on_arrival(_arrivals(t, events, "event_time"), "user_id", "event_time", path, work_path(t.spark, "checkpoint"),
                           {"availableNow": True}).awaitTermination()
    days = t.spark.read.parquet(path)
    kinds = {"week": sketches.per_period(days, "week"), "month": sketches.per_period(days, "month"), "7 days": sketches.sliding(days, 7)}
    day = F.to_date("event_time")
    periods = {"week": F.to_date(F.date_trunc("week", "event_time")), "month": F.to_date(F.date_trunc("month", "event_time"))}
    active = events.select("user_id", day.alias("day"), F.lit("7 days").alias("kind")).distinct().select(
        "kind", F.explode(F.sequence("day", F.date_add("day", 6))).alias("period"), "user_id")
    out = []
    for kind, estimated in kinds.items():
        rows = active if kind == "7 days" else events.select(F.lit(kind).alias("kind"), periods[kind].alias("period"), "user_id")
        exact = rows.groupBy("kind", "period").agg(F.countDistinct("user_id").alias("exact"))
        close = F.abs(F.col("visitors") - F.col("exact")) <= F.greatest(F.lit(1.0), sketches.relative_error() * F.col("exact"))
        out.append(exact.join(estimated, "period", "full").select("kind", "period", F.col("exact").alias("visitors"), close.alias("close")))
    return out[0].unionByName(out[1]).unionByName(out[2])


EXPORT: dict[str, Build] = {
    "s14_sync_state": s14,
    "r6_high_watermark_delta": r06,
    "r7_ordered_chunks": r07,
    "k22_property_profile": k22,
    "k22_property_profile_estimates": k22_approx,
    "k23_one_time_export": k23,
    "k24_incremental_export_outbox": k24_outbox,
    "k24_incremental_export_report": k24_report,
    "k24_incremental_export_failed_and_resumed": k24_failed,
}
REFRESH: dict[str, Build] = {
    "r1_incremental_touchpoints": lambda t: two_batches(t)[0].touchpoints(),
    "r2_incremental_conversions": lambda t: two_batches(t)[0].conversions(),
    "r3_incremental_mart": lambda t: two_batches(t)[0].mart(),
    "r4_mart_with_user_changes": lambda t: once(t, "cursor", store_by_cursor)[0].mart(),
    "k25_refresh_report": lambda t: two_batches(t)[1],
    "rs1_streaming_touchpoints": rs1,
    "rs2_streaming_conversions": lambda t: streamed(t).conversions(),
    "rs2_stateful_conversions": rs2_stateful,
    "rs2_streaming_mart": lambda t: streamed(t).mart(),
    "rs3_streaming_interval_join": rs3,
    "rs4_streaming_funnel": rs4,
    "rs5_streaming_daily_metrics": rs5,
    "rs5_streaming_sliding_metrics": rs5_sliding,
    "rs5_visitor_sketches": rs5_sketches,
}
