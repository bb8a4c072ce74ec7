import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows, same
from trailmark.operators import quantiles
from trailmark.operators.quantiles import exact_percentiles
from trailmark.plans.metrics import fact_aggregate, fact_percentile, metric_query
from trailmark.sources.landing import star

WANTED = {"low": 0.0, "q1": 0.25, "mid": 0.5, "p95": 0.95, "top": 1.0}


def expected(df, keys):
    return df.groupBy(*keys).agg(*[F.percentile("v", p).alias(n) for n, p in WANTED.items()])


@pytest.mark.parametrize("ranges, levels", [(4, 0), (4, 1), (3, 3), (32, 2)])
def test_equals_percentile(spark, ranges, levels):
    random.seed(ranges)
    data = [("hot", None if i % 50 == 0 else random.choice([7.0, random.gauss(0, 5), float(i % 9)])) for i in range(3000)]
    data += [("one", 3.5), ("pair", -1.0), ("pair", 2.0), ("none", None), (None, 1.0), (None, 9.0), (None, None)]
    data += [("same", 4.0)] * 100 + [("z", float(i)) for i in range(77)]
    df = spark.createDataFrame(data, "g string, v double")
    got = exact_percentiles(df, ["g"], "v", WANTED, ranges, levels)
    near = lambda d: d.select("g", *[F.round(c, 9).alias(c) for c in WANTED])
    same(near(got), near(expected(df, ["g"])))


def test_without_keys_and_empty(spark):
    df = spark.createDataFrame([(i, float(i * i % 101)) for i in range(500)], "g int, v double")
    assert rows(exact_percentiles(df, [], "v", WANTED)) == rows(expected(df, []))
    assert rows(exact_percentiles(df.limit(0), [], "v", WANTED)) == [(None,) * 5]
    assert rows(exact_percentiles(df.limit(0), ["g"], "v", WANTED)) == []


def test_two_keys_and_integers(spark):
    df = spark.createDataFrame([(i % 3, None if i % 2 else "x", i * 37 % 101) for i in range(600)], "a int, b string, v int")
    same(exact_percentiles(df, ["a", "b"], "v", WANTED, 5, 1), expected(df, ["a", "b"]))


def test_no_task_orders_more_than_a_range(spark, monkeypatch):
    """Of a group of 100,000 distinct values the last window sees a small part."""
    n = 100_000
    df = spark.range(n).select(F.lit("g").alias("g"), (F.col("id") * 7919 % n).cast("double").alias("v"))
    seen, real = [], quantiles._at_ranks

    def watch(inside, cuts, targets, ranges, levels):
        if not levels:
            seen.append(inside.count())
        return real(inside, cuts, targets, ranges, levels)

    monkeypatch.setattr(quantiles, "_at_ranks", watch)
    got = exact_percentiles(df, ["g"], "v", {"p": 0.75}, 32, 1)
    assert got.first()["p"] == np.percentile(np.arange(n), 75)
    assert 0 < seen[0] < n / 10


def test_metrics_use_it(spark):
    t = star(spark, SF)
    exact = metric_query(t, ["avg_inp", "p75_inp", fact_percentile("p90", "inp", 0.9)], ["browser"])
    plain = metric_query(t, ["avg_inp", fact_aggregate("p75_inp", "inp", "percentile({}, 0.75)"), fact_aggregate("p90", "inp", "percentile({}, 0.9)")], ["browser"])
    near = lambda d: d.select("browser", *[F.round(c, 6).alias(c) for c in d.columns[1:]])
    same(near(exact), near(plain))


def test_cuts_that_differ_between_evaluations_do_no_harm(spark, monkeypatch):
    """Merged in another order a sketch gives other cuts; here every evaluation does, and none is shared."""
    from trailmark.operators import quantiles

    def elsewhere(_):
        import random

        return sorted({float(random.SystemRandom().randrange(1000)) for _ in range(6)})

    anywhere = F.udf(elsewhere, "array<double>").asNondeterministic()
    monkeypatch.setattr(quantiles, "_cuts", lambda ranges: anywhere(F.max("v")))
    df = spark.range(6000).select((F.col("id") % 3).alias("g"), F.pmod(F.hash("id"), F.lit(1000)).cast("double").alias("v"))
    wanted = {f"p{i}": i / 10 for i in range(11)}
    plain = df.groupBy("g").agg(*[F.expr(f"percentile(v, {p})").alias(n) for n, p in wanted.items()])
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = rows(quantiles.exact_percentiles(df, ["g"], "v", wanted), "g")
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert np.allclose(got, rows(plain, "g"))
