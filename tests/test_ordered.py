import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import same
from trailmark.operators.ordered import sessionize, with_order


def hot_rows(spark, n=4000):
    """A third of the rows in one key, some in a NULL key, many equal times."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 17 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(n).select(
        "id", key.alias("k"), F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("id") * 7919, F.lit(700)) * 1800).alias("t"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 11).alias("v"))


@pytest.mark.parametrize("width", [60, 3600, 86400])
def test_equals_plain_window(spark, width):
    df = hot_rows(spark)
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = df.select("*", F.row_number().over(w).cast("long").alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"),
                      F.lag("v").over(w).alias("before"), F.lead("t").over(w).alias("after"))
    got = with_order(df, ["k"], "t", ["id"], position="rn", size="n", previous={"before": "v"}, following={"after": "t"}, width=width)
    same(got, plain)


@pytest.mark.parametrize("gap", [900, 3600, 86400])
def test_sessionize_equals_gap_scan(spark, gap):
    df = hot_rows(spark).filter("k IS NOT NULL")
    w = Window.partitionBy("k").orderBy("t")
    idle = F.unix_seconds("t") - F.unix_seconds(F.lag("t").over(w)) > gap
    plain = df.withColumn("new", F.when(F.coalesce(idle, F.lit(True)), 1).otherwise(0)).withColumn(
        "s", F.sum("new").over(w)).drop("new")
    same(sessionize(df, ["k"], "t", gap, "s"), plain)


def test_hot_key_is_spread_over_tasks(spark):
    """The row-level shuffle keys on (key, bucket), not on the key alone."""
    df = with_order(hot_rows(spark), ["k"], "t", ["id"], position="rn")
    plan = df._jdf.queryExecution().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x or "hashpartitioning(_k0" in x]
    assert any("_bucket" in x for x in exchanges)
