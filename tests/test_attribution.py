from datetime import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, same
from trailmark.config import ALL_MODELS, AttributionConfig
from trailmark.operators import attribution, conversions, quality

CFG = AttributionConfig(as_of="2024-02-01 00:00:00")
TOUCH = "user_id string, session_id string, event_time timestamp, source string, medium string, campaign string"
CONV = ("user_id string, converted_at timestamp, conversion_revenue decimal(38,2), previous_conversion_at timestamp, "
        "conversion_index long")

CHANNELS = [("google", "cpc", "c1"), ("direct", "direct", "organic/untracked"), ("email", "email", "c3"),
            ("partner", "referral", "organic/untracked")]


def paths(spark):
    """Users 1 to 4 with as many sessions, converting for 100 times that."""
    touch = [(f"user{n}", f"u{n}_s{i + 1}", dt(2024, 1, 1 + i, 10), *CHANNELS[i]) for n in range(1, 5) for i in range(n)]
    conv = [(f"user{n}", dt(2024, 1, 6, 12), Decimal(100 * n), None, 1) for n in range(1, 5)]
    return spark.createDataFrame(touch, TOUCH), spark.createDataFrame(conv, CONV)


def credit(mart, model):
    return {(r["user_id"], r["session_number"]): round(r["attributed_revenue"], 2)
            for r in mart.filter(F.col("attribution_model") == model).collect()}


@pytest.fixture(scope="module")
def mart(spark):
    return attribution.attribution_mart(*paths(spark), CFG, extra=("conversion_index",)).cache()


def test_u_shaped(mart):
    assert credit(mart, "40-20-40 U-Shaped") == {
        ("user1", 1): 100, ("user2", 1): 100, ("user2", 2): 100,
        ("user3", 1): 120, ("user3", 2): 60, ("user3", 3): 120,
        ("user4", 1): 160, ("user4", 2): 40, ("user4", 3): 40, ("user4", 4): 160}


def test_linear_first_last(mart):
    assert credit(mart, "Linear") == {(f"user{n}", i + 1): 100 for n in range(1, 5) for i in range(n)}
    assert credit(mart, "First Touch") == {(f"user{n}", 1): 100 * n for n in range(1, 5)}
    assert credit(mart, "Last Touch") == {(f"user{n}", n): 100 * n for n in range(1, 5)}


def test_full_credit_once_per_channel(mart):
    full = mart.filter(F.col("attribution_model") == "Full Credit")
    assert full.count() == 10 and full.filter("attributed_revenue != 100 * cast(right(user_id, 1) AS int)").isEmpty()


def test_models_agree(mart):
    assert quality.revenue_integrity(mart).isEmpty()
    assert quality.session_ordering(mart).isEmpty()
    assert quality.completeness(mart).isEmpty()
    assert {r[0] for r in mart.select("attribution_model").distinct().collect()} == set(ALL_MODELS)


def test_four_model_check_flags_the_fifth(mart):
    four = [m for m in ALL_MODELS if m != "Full Credit"]
    found = quality.completeness(mart, four)
    assert found.filter(F.col("assertion").startswith("unexpected")).count() == 10
    assert found.filter(F.col("assertion").startswith("only 5 of 4")).count() == 4


def window_case(spark):
    touch = [("user1", "u1_s1", dt(2024, 1, 6, 23, 59, 59)), ("user1", "u1_s2", dt(2024, 1, 7)),
             ("user1", "u1_s3", dt(2024, 1, 10)), ("user1", "u1_s4", dt(2024, 1, 22)),
             ("user2", "u2_s1", dt(2024, 1, 8)), ("user2", "u2_s2", dt(2024, 1, 12))]
    conv = [("user1", dt(2024, 1, 21), Decimal(100), None, 1), ("user2", dt(2024, 1, 10), Decimal(100), None, 1),
            ("user2", dt(2024, 1, 20), Decimal(200), dt(2024, 1, 10), 2)]
    return (spark.createDataFrame([(*t, "s", "m", "c") for t in touch], TOUCH), spark.createDataFrame(conv, CONV))


@pytest.mark.parametrize("link", [attribution.attributed_sessions, attribution.interval_join])
def test_window_and_double_counting(spark, link):
    got = link(*window_case(spark), CFG, extra=("conversion_index",)).select("session_id", "conversion_index")
    assert sorted(rows(got)) == [("u1_s2", 1), ("u1_s3", 1), ("u2_s1", 1), ("u2_s2", 2)]


def test_touch_at_the_conversion_instant_goes_to_the_next(spark):
    touch = spark.createDataFrame([("u", "s", dt(2024, 1, 10), "a", "b", "c")], TOUCH)
    conv = spark.createDataFrame([("u", dt(2024, 1, 10), Decimal(1), None, 1), ("u", dt(2024, 1, 10), Decimal(2), dt(2024, 1, 10), 2),
                                  ("u", dt(2024, 1, 11), Decimal(3), dt(2024, 1, 10), 3)], CONV)
    for link in (attribution.attributed_sessions, attribution.interval_join):
        assert rows(link(touch, conv, CFG, ("conversion_index",)).select("conversion_index")) == [(3,)]


def test_simultaneous_conversions_only_the_first_gets_the_path(spark):
    touch = spark.createDataFrame([("u", "s", dt(2024, 1, 9), "a", "b", "c")], TOUCH)
    conv = spark.createDataFrame([("u", dt(2024, 1, 10), Decimal(1), None, 1), ("u", dt(2024, 1, 10), Decimal(2), dt(2024, 1, 10), 2)], CONV)
    for link in (attribution.attributed_sessions, attribution.interval_join):
        assert rows(link(touch, conv, CFG, ("conversion_index",)).select("conversion_index")) == [(1,)]


def test_unpaid_conversions_keep_full_credit_only(spark):
    touch = spark.createDataFrame([("u", "s", dt(2024, 1, 9), "a", "b", "c"), ("v", "s2", dt(2024, 1, 9), "a", "b", "c")], TOUCH)
    conv = spark.createDataFrame([("u", dt(2024, 1, 10), Decimal(0), None, 1), ("v", dt(2024, 1, 10), None, None, 1)], CONV)
    mart = attribution.attribution_mart(touch, conv, CFG, extra=("conversion_index",))
    assert sorted(rows(mart.select("user_id", "attribution_model"))) == [("u", "Full Credit"), ("v", "Full Credit")]
    assert quality.completeness(mart).count() == 2
    assert quality.completeness(mart, allow_unpaid=True).isEmpty()


def test_hot_user_equals_pairwise_join(spark):
    """One user with most rows, many ties: both linkages and the plain condition agree."""
    r = spark.range(3000)
    at = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("id") * 7919, F.lit(500)) * 3600)
    user = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 40))
    touch = r.select(user.alias("user_id"), F.concat(F.lit("s"), "id").alias("session_id"), at.alias("event_time"),
                     F.lit("a").alias("source"), F.lit("b").alias("medium"), F.lit("c").alias("campaign"))
    found = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 40)).alias("user_id"),
        F.lit("x").alias("conversion_session_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("id") * 104729, F.lit(480)) * 3600).alias("converted_at"),
        F.col("id").cast("decimal(38,2)").alias("conversion_revenue"), F.col("id").alias("event_id"))
    conv = conversions.ordered_conversions(found).cache()
    extra = ("conversion_index",)
    fast, day = attribution.attributed_sessions(touch, conv, CFG, extra), attribution.interval_join(touch, conv, CFG, extra)
    c = conv.withColumnRenamed("user_id", "cu")
    lower = F.expr("converted_at - INTERVAL 14 DAYS")
    plain = touch.join(c, F.col("user_id") == F.col("cu")).filter(
        (F.col("event_time") < F.col("converted_at")) & (F.col("event_time") >= lower)
        & (F.col("event_time") >= F.coalesce("previous_conversion_at", lower)))
    plain = plain.withColumnRenamed("event_time", "session_start_time").select(*fast.columns)
    same(fast, plain)
    same(day, plain)


def test_price_scale(spark):
    df = spark.createDataFrame([('{"price":"12.99"}',), ('{"price":"abc"}',), ('{"price":"$5"}',), ("{}",), (None,)], "p string")
    from trailmark.sources.staging import price_of

    assert [r[0] for r in df.select(price_of(F.col("p"), 2)).collect()] == [Decimal("12.99"), None, None, None, None]
    assert df.select(price_of(F.col("p"), 0)).first()[0] == 13
