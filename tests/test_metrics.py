import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows, same
from trailmark.plans.metrics import METRICS, SESSIONS, WEB_VITAL_THRESHOLDS, FACTS, fact_aggregate, metric, metric_query
from trailmark.plans.model import RELATIONSHIPS, TABLES, route
from trailmark.sources.landing import STAR_SQL, star


@pytest.fixture(scope="module")
def t(spark):
    return star(spark, SF)


def test_inventory():
    assert len(METRICS) == 54 and len(TABLES) == 31 and len(RELATIONSHIPS) == 30
    assert set(TABLES) == set(STAR_SQL)
    assert set(WEB_VITAL_THRESHOLDS) <= set(FACTS)


def test_every_metric_evaluates(t):
    for base in dict.fromkeys(m.base for m in METRICS):
        names = [m.name for m in METRICS if m.base == base]
        assert metric_query(t, names).columns == names


@pytest.mark.parametrize("alias, name", [
    ("pvs", "page_view_count"), ("Average LCP", "avg_lcp"), ("5xx errors", "server_error_count"),
    ("crashes", "unhandled_exception_count"), ("visitor count", "user_count")])
def test_synonyms(alias, name):
    assert metric(alias).name == name


def test_unknown_names(t):
    with pytest.raises(KeyError):
        metric("no such metric")
    with pytest.raises(KeyError):
        metric_query(t, ["pvs"], ["no such dimension"])


def test_one_to_many_is_refused(t):
    with pytest.raises(ValueError, match="not many-to-one"):
        metric_query(t, ["user_count"], ["browser"])
    with pytest.raises(ValueError):
        route("page_definitions", "events")


def test_joins_do_not_multiply_rows(t):
    by_page = metric_query(t, ["click_count"], {"page": "page", "uid": "uid", "device": "device type"})
    assert by_page.agg(F.sum("click_count")).first()[0] == t["clicks"].count()


def test_bases_are_combined_without_fan_out(t):
    both = metric_query(t, ["click_count", "page_view_count"], {"user_id": "user_id"})
    clicks = t["clicks"].groupBy("user_id").agg(F.count("*").alias("click_count"))
    views = t["page_views"].groupBy("user_id").agg(F.count("*").alias("page_view_count"))
    same(both, clicks.join(views, "user_id", "full").select("user_id", "click_count", "page_view_count"))


def test_null_dimension_is_one_group(t):
    got = metric_query(t, ["click_count", "page_view_count", SESSIONS], {"page": "page"})
    assert got.filter("page IS NULL").count() == 1


def test_order_and_limit(t):
    got = rows(metric_query(t, ["click_count"], {"city": "city"}, order_by="click_count", limit=3))
    counts = [r[1] for r in got]
    assert len(got) == 3 and counts == sorted(counts, reverse=True)


def test_only_needed_columns_are_read(t):
    df = metric_query(t, ["avg_lcp"], {"browser": "browser"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "session_id" not in plan and "Python" not in plan


def test_adhoc_fact(t):
    p90 = metric_query(t, [fact_aggregate("p90", "lcp", "percentile({}, 0.9)")]).first()[0]
    assert p90 == t["loads"].agg(F.percentile("largest_paint_time_millis", 0.9)).first()[0]
