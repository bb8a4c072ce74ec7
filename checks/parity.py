"""Session counts, user counts and funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from checks.common import CFG, DAY, TZ, Build
from trailmark.config import work_path
from trailmark.functions.time import period
from trailmark.operators import counts, funnel, touchpoints
from trailmark.sources.landing import AS_OF, Star
from trailmark.sources.layout import save_colocated
from trailmark.sources.staging import Tables


def k01(t: Star) -> DataFrame:
    return counts.sessions_by_page(t["events"], t["source_properties"], t["page_definitions"], "404 Page", DAY, TZ)


def k02(t: Star) -> DataFrame:
    return counts.device_and_identified_counts(t["events"], t["users"], DAY, TZ)


def k03(t: Star) -> DataFrame:
    return counts.ui_user_count(t["events"], t["users"], DAY, TZ)


def k04(t: Star) -> DataFrame:
    return counts.property_id_count(t["events"], t["user_properties"], "enterprise_id", DAY, TZ)


def hits(t: Star, day: str | None = None) -> DataFrame:
    return funnel.step_hits(t["events"], t["source_properties"], t["page_definitions"], t["custom_events"],
                            funnel.PURCHASE_FUNNEL, day, TZ)


def k05(t: Star) -> DataFrame:
    return funnel.first_touch_funnel(hits(t), 5)


def k05_day(t: Star) -> DataFrame:
    return funnel.first_touch_funnel(hits(t, DAY), 5)


def k06(t: Star) -> DataFrame:
    return funnel.chained_funnel(hits(t), 5)


def k06_day(t: Star) -> DataFrame:
    return funnel.chained_funnel(hits(t, DAY), 5)


BACK_TO_SEARCH = (funnel.Step(pages=("Search",)), funnel.Step(pages=("ProductPage",)), funnel.Step(pages=("Search",)))


def repeated_page(t: Star) -> DataFrame:
    """A funnel whose first and last step are the same page."""
    return funnel.chained_funnel(funnel.step_hits(
        t["events"], t["source_properties"], t["page_definitions"], t["custom_events"], BACK_TO_SEARCH), 3)


def k05_week(t: Star) -> DataFrame:
    week = period("last week", AS_OF)
    return funnel.first_touch_funnel(funnel.step_hits(
        t["events"], t["source_properties"], t["page_definitions"], t["custom_events"], funnel.PURCHASE_FUNNEL, period=week), 5)


EVENT_KEYS = {"events": "id", "source_properties": "event_id", "custom_events": "event_id"}
BUCKETS = 8
_LAYOUTS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def colocated(t: Star) -> dict[str, DataFrame]:
    """The star with events and per-event tables bucketed on the event key, saved once per application."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _LAYOUTS:
        prefix = f"colocated_{len(_LAYOUTS)}_"
        save_colocated({n: t[n] for n in EVENT_KEYS}, EVENT_KEYS, BUCKETS, prefix=prefix, path=work_path(t.spark, "colocated"))
        saved = Tables(t.spark, f"default.{prefix}{{}}")
        _LAYOUTS[key] = {**{n: saved[n] for n in EVENT_KEYS}, **{n: t[n] for n in ("page_definitions", "users")}}
    return _LAYOUTS[key]


def k07(t: dict[str, DataFrame]) -> DataFrame:
    return touchpoints.touchpoints(t["events"], t["source_properties"], t["users"], CFG)


PARITY: dict[str, Build] = {
    "k01_sessions_by_page": k01,
    "k01_sessions_by_page_colocated": lambda t: k01(colocated(t)),
    "k02_device_and_identified_counts": k02,
    "k03_ui_user_count": k03,
    "k04_property_id_count": k04,
    "k05_funnel_first_touch": k05,
    "k05_funnel_first_touch_colocated": lambda t: k05(colocated(t)),
    "k05_funnel_first_touch_local_day": k05_day,
    "k05_funnel_first_touch_week": k05_week,
    "k06_funnel_chained": k06,
    "k07_touchpoints_colocated": lambda t: k07(colocated(t)),
    "k06_funnel_repeated_page": repeated_page,
    "k06_funnel_chained_local_day": k06_day,
}
