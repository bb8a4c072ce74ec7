"""Time the headline queries and print one JSON line.

Every result is fully computed into Spark's noop sink.  Source shaping (``landing``) stands for the
warehouse's existing tables and is reported apart; ``value`` is the sum of the query times.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks import entries
from checks.common import CFG
from trailmark.config import clean_work, prepare_session, work_path
from trailmark.plans.refresh import AttributionStore
from trailmark.sources.landing import star

HEADLINE = [
    "k01_sessions_by_page", "k02_device_and_identified_counts", "k03_ui_user_count", "k04_property_id_count",
    "k05_funnel_first_touch", "k06_funnel_chained", "k05_funnel_first_touch_local_day", "k06_funnel_chained_local_day",
    "k07_touchpoints", "k08_conversions", "k16_attribution_mart", "k26_channel_performance",
    "k18_session_ordering", "k21_metrics_across_bases", "metric_loads", "metric_clicks",
    "b09_entry_and_exit_pages", "b10_next_page", "b13_frustration_score", "b16_anomaly_scores",
    "k24_incremental_export_outbox",
]
REPEATS = 2


def timed(run) -> float:
    start = time.perf_counter()
    result = run()
    if result is not None:
        result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def refresh_times(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Building the attribution tables at once against folding in the last day."""
    t = star(spark, sf_dir)
    store = AttributionStore(spark, work_path(spark, "bench-store"), CFG, buckets=8, users_by_cursor=True)
    at, last_day = F.col("event_time"), F.lit("2024-01-30").cast("timestamp")
    part = lambda cond: (t["events"].filter(cond), t["source_properties"], t["custom_events"].filter(cond), t["users"])
    return {
        "mart_build": timed(lambda: store.refresh(*part(at < last_day))),
        "mart_refresh_last_day": timed(lambda: store.refresh(*part(at >= last_day))),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    landing = timed(lambda: star(spark, sf_dir)["users"])
    queries = entries.all_queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        seconds[name] = min(timed(lambda: queries[name](spark, sf_dir)) for _ in range(REPEATS))
    seconds.update(refresh_times(spark, sf_dir))
    clean_work(spark)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()}, "landing": round(landing, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
