import pytest
from pyspark.sql import functions as F

from checks import parity

from tests.conftest import SF, same
from trailmark.operators import touchpoints
from trailmark.sources.landing import star
from trailmark.sources.layout import save_colocated, write_by_day
from trailmark.sources.staging import Tables
from trailmark.config import AttributionConfig


def test_colocated_event_join_needs_no_exchange(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS colocated LOCATION '{tmp_path}/db'")
    t = star(spark, SF)
    save_colocated({n: t[n] for n in ("events", "source_properties")},
                   {"events": "id", "source_properties": "event_id"}, 4, "colocated")
    stored = Tables(spark, "colocated.{}", {"events": "events", "source_properties": "source_properties"})
    cfg = AttributionConfig(as_of="2024-01-31 00:00:00")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = touchpoints.classified_events(stored["events"], stored["source_properties"], cfg)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        same(got, touchpoints.classified_events(t["events"], t["source_properties"], cfg))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["k01_sessions_by_page", "k05_funnel_first_touch", "k07_touchpoints"])
def test_colocated_queries_move_no_events_before_their_join(spark, name):
    t = star(spark, SF)
    got = parity.PARITY[f"{name}_colocated"](t)
    want = parity.k07(t) if name.startswith("k07") else parity.PARITY[name](t)
    same(got, want)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Definitions stay small enough to broadcast, events and context do not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8000")
    try:
        plan = parity.PARITY[f"{name}_colocated"](t)._jdf.queryExecution().sparkPlan().toString()
        moved = parity.PARITY[f"{name}_colocated"](t)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin [event_id" in plan or "ShuffledHashJoin [event_id" in plan
    lines = moved.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(event_id" in line]
    # The funnel's tags come from two tables, and only their narrow union moves.
    assert len(below) == (name == "k05_funnel_first_touch") and all(line.strip(" :+-").startswith("Union") for line in below)


def test_urls_stay_out_of_the_shuffle(spark):
    t = star(spark, SF)
    df = touchpoints.classified_events(t["events"], t["source_properties"], AttributionConfig(as_of="2024-01-31 00:00:00"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    join = plan.index("Join")
    assert "regexp_extract" not in plan[:join] and "regexp_extract" in plan[join:]


def test_day_folders(spark, tmp_path):
    t = star(spark, SF)
    write_by_day(t["clicks"], str(tmp_path / "clicks"))
    day = spark.read.parquet(str(tmp_path / "clicks")).filter(F.col("event_date") == "2024-01-10")
    want = t["clicks"].filter(F.to_date("event_time") == "2024-01-10")
    same(day.drop("event_date"), want)
