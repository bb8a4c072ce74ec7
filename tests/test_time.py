import pytest
from pyspark.sql import functions as F

from trailmark.functions.time import clock_range, on_local_day, period

TZ = "America/Denver"


# An ordinary day, the 23-hour day and the 25-hour day.
@pytest.mark.parametrize("day", ["2024-01-10", "2024-03-10", "2024-11-03"])
def test_local_day_is_the_calendar_day(spark, day):
    start = F.lit(f"{day} 00:00:00").cast("timestamp") - F.expr("INTERVAL 2 DAYS")
    df = spark.range(0, 6 * 86400, 600).select((start + F.make_dt_interval(secs=F.col("id"))).alias("t"))
    plain = df.filter(F.to_date(F.from_utc_timestamp("t", TZ)) == F.lit(day).cast("date"))
    got = df.filter(on_local_day(F.col("t"), day, TZ))
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    assert got.count() == {"2024-01-10": 144, "2024-03-10": 138, "2024-11-03": 150}[day]


def test_local_day_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.timestamp_seconds("id").alias("t")).write.parquet(path)
    df = spark.read.parquet(path).filter(on_local_day(F.col("t"), "2024-01-10", TZ))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t," in plan and "LessThan(t," in plan


@pytest.mark.parametrize("name, tz, lo, hi", [
    ("today", "UTC", "2024-01-30 00:00:00", "2024-01-30 18:00:00"),
    ("today", TZ, "2024-01-30 07:00:00", "2024-01-30 18:00:00"),
    ("yesterday", TZ, "2024-01-29 07:00:00", "2024-01-30 07:00:00"),
    ("last week", "UTC", "2024-01-23 18:00:00", "2024-01-30 18:00:00"),
    ("past month", "UTC", "2023-12-31 18:00:00", "2024-01-30 18:00:00"),
])
def test_period_vocabulary(spark, name, tz, lo, hi):
    p = period(name, "2024-01-30 18:00:00", tz)
    got = spark.range(1).select(p.start.cast("string"), p.end.cast("string")).first()
    assert tuple(got) == (lo, hi)


def test_unknown_period():
    with pytest.raises(ValueError):
        period("fortnight", "2024-01-30 18:00:00")


def test_clock_range(spark):
    p = clock_range("2024-01-29", "14:00:00", "16:00:00", TZ)
    assert tuple(spark.range(1).select(p.start.cast("string"), p.end.cast("string")).first()) == (
        "2024-01-29 21:00:00", "2024-01-29 23:00:00")
