"""Day sketches merge into the same estimates however the rows arrived."""

from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trailmark.config import work_path
from trailmark.operators import sketches
from trailmark.streaming import jobs

SCHEMA = "user_id string, event_time timestamp, page string"


@pytest.fixture(scope="module")
def visits(spark):
    n = spark.range(40_000).select(
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(9_000))).alias("user_id"),
        (F.lit(dt(2024, 1, 1)) + F.make_dt_interval(F.pmod(F.hash("id"), F.lit(40)).cast("int"))).cast("timestamp").alias("event_time"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 4)).alias("page"))
    return spark.createDataFrame(n.toPandas(), SCHEMA)


def exact(df, period, *by):
    return df.groupBy(F.to_date(F.date_trunc(period, "event_time")).alias("period"), *by).agg(F.countDistinct("user_id").alias("n"))


@pytest.mark.parametrize("period", ["day", "week", "month", "year"])
def test_periods_within_the_bound(visits, period):
    days = sketches.daily_sketches(visits, "user_id", "event_time", ["page"])
    got = sketches.per_period(days, period, ["page"]).join(exact(visits, period, "page"), ["period", "page"], "full").collect()
    assert got and all(abs(r["visitors"] - r["n"]) <= max(1, sketches.relative_error() * r["n"]) for r in got)


def test_sliding_windows_within_the_bound(visits):
    got = {r["period"]: r["visitors"] for r in sketches.sliding(sketches.daily_sketches(visits, "user_id", "event_time"), 7).collect()}
    held = visits.toPandas()
    held["day"] = held["event_time"].dt.date
    assert len(got) == 46
    for end, n in got.items():
        want = held[(held["day"] <= end) & (held["day"] > end - timedelta(days=7))]["user_id"].nunique()
        assert abs(n - want) <= max(1, sketches.relative_error() * want)


def test_stream_late_rows_and_repeated_sketches_agree_with_the_batch(spark, visits):
    whole = sketches.daily_sketches(visits, "user_id", "event_time")
    path, source = work_path(spark, "sketches"), work_path(spark, "arrivals")
    # Arrivals in no order of time: every day comes in several batches.
    visits.repartition(5).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(source)
    checkpoint = work_path(spark, "checkpoint")
    run = lambda: jobs.sketch_on_arrival(stream, "user_id", "event_time", path, checkpoint, {"availableNow": True}).awaitTermination()
    run()
    kept = spark.read.parquet(path).drop("batch")
    want = rows(sketches.per_period(whole, "month"), "period")
    assert kept.count() > whole.count() and rows(sketches.per_period(kept, "month"), "period") == want
    assert rows(sketches.per_period(kept.unionByName(whole), "month"), "period") == want
    run()
    assert spark.read.parquet(path).count() == kept.count()


def test_nulls_and_nothing(spark):
    data = spark.createDataFrame([(None, dt(2024, 1, 1), "a"), ("u", dt(2024, 1, 2), "a"), ("u", dt(2024, 1, 2), None)], SCHEMA)
    days = sketches.daily_sketches(data, "user_id", "event_time")
    assert [r[1] for r in rows(sketches.per_period(days, "day"), "period")] == [0, 1]
    assert rows(sketches.sliding(days.limit(0), 7)) == []
