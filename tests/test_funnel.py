from datetime import datetime as dt

from tests.conftest import rows
from trailmark.operators import funnel

HITS = "user_id string, session_id string, event_time timestamp, step int"


def at(hour):
    return dt(2024, 1, 10, hour)


def test_first_touch_and_chained_differ(spark):
    """Step 2 seen both before and after step 1: only the chained form counts it."""
    hits = spark.createDataFrame([("u", "s", at(1), 2), ("u", "s", at(2), 1), ("u", "s", at(3), 2), ("u", "s", at(4), 3)], HITS)
    assert rows(funnel.first_touch_funnel(hits, 3).select("stp1_sessions", "stp2_sessions", "stp3_sessions")) == [(1, 0, 0)]
    assert rows(funnel.chained_funnel(hits, 3).select("stp1_sessions", "stp2_sessions", "stp3_sessions")) == [(1, 1, 1)]


def test_rates_and_empty_base(spark):
    hits = spark.createDataFrame([("u", "s1", at(1), 1), ("u", "s2", at(1), 1), ("u", "s3", at(1), 1), ("u", "s1", at(2), 2)], HITS)
    got = funnel.first_touch_funnel(hits, 4).first().asDict()
    assert (got["stp1_sessions"], got["stp2_sessions"], got["stp1_to_stp2_pct"]) == (3, 1, 33.3)
    assert got["stp2_to_stp3_pct"] == 0.0 and got["stp3_to_stp4_pct"] is None and got["overall_pct"] == 0.0


def test_equal_times_do_not_progress(spark):
    hits = spark.createDataFrame([("u", "s", at(1), 1), ("u", "s", at(1), 2)], HITS)
    assert funnel.first_touch_funnel(hits, 2).first()["stp2_sessions"] == 0
    assert funnel.chained_funnel(hits, 2).first()["stp2_sessions"] == 0


def test_shared_session_counts_pairs_after_step_one(spark):
    hits = spark.createDataFrame(
        [(u, "s", at(h), step) for u in ("a", "b") for h, step in ((1, 1), (2, 2))], HITS)
    got = funnel.first_touch_funnel(hits, 2).first()
    assert (got["stp1_sessions"], got["stp2_sessions"], got["stp1_to_stp2_pct"]) == (1, 2, 200.0)
    # The chained form counts sessions at every step.
    assert funnel.chained_funnel(hits, 2).first()["stp2_sessions"] == 1


def test_started_not_finished(spark):
    hits = spark.createDataFrame(
        [("a", "s1", at(1), 1), ("a", "s1", at(2), 2), ("b", "s2", at(1), 1), ("c", "s3", at(1), 2),
         ("a", "s4", at(1), 1)], HITS)
    assert funnel.started_not_finished(hits, 2).first()[0] == 1
