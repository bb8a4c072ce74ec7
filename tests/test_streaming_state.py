"""Streaming state is bounded by the watermark and slices add up to the batch result."""

from datetime import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from trailmark.config import work_path
from trailmark.operators import funnel
from trailmark.streaming import jobs

HITS = "user_id string, session_id string, event_time timestamp, step int"


def test_state_of_past_slices_is_dropped(spark):
    arrivals, source = [], work_path(spark, "arrivals")
    for month in (1, 3, 5):
        arrivals.append([(f"u{month}{i}", f"s{month}{i}", dt(2024, month, 1 + i % 3, 10), 1 + i % 2) for i in range(10)])
    for data in arrivals:
        spark.createDataFrame(data, HITS).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(HITS).option("maxFilesPerTrigger", 1).parquet(source)
    log = work_path(spark, "updates")
    query = jobs.append_updates(jobs.running_funnel(stream, 2, "1 day"), log, work_path(spark, "checkpoint"), {"availableNow": True})
    query.awaitTermination()
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(kept) <= 20 and kept[-1] <= 10
    got = jobs.first_of_slices(jobs.latest(spark, log, ["user_id", "session_id", "slice"], jobs.running_funnel(stream, 2, "1 day").schema), 2)
    hits = spark.createDataFrame([r for data in arrivals for r in data], HITS)
    assert rows(got, "session_id") == rows(funnel.first_touch_times(hits, 2), "session_id")


def test_session_over_midnight_is_one(spark):
    at = lambda d, h: dt(2024, 1, d, h)
    slices = spark.createDataFrame(
        [("s", "u", at(1, 0), 2, at(1, 23), 1, "a", "m", None), ("s", "u", at(2, 0), 1, at(2, 1), 2, "b", "n", None)],
        "session_id string, user_id string, slice timestamp, rank int, event_time timestamp, event_id int, source string, medium string, campaign string")
    assert rows(jobs.best_of_slices(slices).select("source", F.hour("event_time"))) == [("b", 1)]
