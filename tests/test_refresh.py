from datetime import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows, same
from trailmark.config import AttributionConfig, work_path, work_table
from trailmark.operators import attribution, conversions, touchpoints
from trailmark.plans import refresh
from trailmark.plans.refresh import AttributionStore, row_changes, same_time_range
from trailmark.sources.landing import star
from trailmark.sources.versions import Conflict

CFG = AttributionConfig(as_of="2024-01-31 00:00:00")
EVENTS = "id bigint, user_id string, session_id string, event_time timestamp, event_type string, processed_time timestamp"
SP = ("event_id bigint, event_time timestamp, url_full_url string, url_query string, url_path string, "
      "initial_referrer_host string, initial_referrer_full_url string")
CUSTOM = "event_id bigint, user_id string, session_id string, event_time timestamp, event_name string, event_properties string"
USERS = "id string, uid string"


def store(spark, cfg=CFG):
    return AttributionStore(spark, work_path(spark, "store"), cfg, buckets=4)


def full(events, sp, custom, users, cfg=CFG):
    tp = work_table(touchpoints.touchpoints(events, sp, users, cfg), "tp")
    cv = work_table(conversions.conversions(custom, users, cfg), "cv")
    return attribution.attribution_mart(tp, cv, cfg)


def visits(spark, data):
    """(id, device, session, time) events with an untagged context row each."""
    ev = spark.createDataFrame([(i, d, s, t, "view", t) for i, d, s, t in data], EVENTS)
    sp = spark.createDataFrame([(i, t, "https://a/?gclid=1", None, None, None, None) for i, _, _, t in data], SP)
    return ev, sp


def sales(spark, data):
    return spark.createDataFrame([(i, d, s, t, "Checkout Success", '{"price":"100"}') for i, d, s, t in data], CUSTOM)


def test_one_new_conversion_adds_five_rows(spark):
    ev, sp = visits(spark, [(i, f"user{i}", f"u{i}_s1", dt(2024, 1, 1, 10)) for i in (1, 2, 3)])
    nobody = spark.createDataFrame([], USERS)
    st = store(spark)
    first = sales(spark, [(11, "user1", "u1_s1", dt(2024, 1, 6, 12)), (12, "user2", "u2_s1", dt(2024, 1, 6, 12))])
    assert rows(st.refresh(ev, sp, first, nobody)) == [(10, 0, 0)]
    more = sales(spark, [(13, "user3", "u3_s1", dt(2024, 1, 6, 12))])
    assert rows(st.refresh(ev.limit(0), sp, more, nobody)) == [(5, 0, 10)]
    # The same batch again changes nothing.
    assert rows(st.refresh(ev.limit(0), sp, more, nobody)) == [(0, 0, 15)]


def test_late_conversion_takes_over_the_path(spark):
    """A conversion arriving late, between a touchpoint and the known conversion."""
    ev, sp = visits(spark, [(1, "d", "s1", dt(2024, 1, 1)), (2, "d", "s2", dt(2024, 1, 5))])
    nobody = spark.createDataFrame([], USERS)
    st = store(spark)
    st.refresh(ev, sp, sales(spark, [(10, "d", "s9", dt(2024, 1, 8))]), nobody)
    st.refresh(ev.limit(0), sp, sales(spark, [(11, "d", "s8", dt(2024, 1, 3))]), nobody)
    linear = st.mart().filter("attribution_model = 'Linear'").select("session_id", "converted_at", "attributed_revenue")
    assert rows(linear, "session_id") == [("s1", dt(2024, 1, 3), 100.0), ("s2", dt(2024, 1, 8), 100.0)]


def test_identification_moves_history_to_the_user(spark):
    ev, sp = visits(spark, [(1, "d1", "s1", dt(2024, 1, 1)), (2, "d2", "s2", dt(2024, 1, 5))])
    st = store(spark)
    sold = sales(spark, [(10, "d2", "s9", dt(2024, 1, 8))])
    st.refresh(ev, sp, sold, spark.createDataFrame([("d2", "anna")], USERS))
    assert st.mart().filter("attribution_model = 'Linear'").count() == 1
    both = spark.createDataFrame([("d1", "anna"), ("d2", "anna")], USERS)
    st.refresh(ev.limit(0), sp, sold.limit(0), both)
    same(st.mart(), full(ev, sp, sold, both))
    assert st.mart().filter("attribution_model = 'Linear'").count() == 2
    # And back again: the rows of both identities are rebuilt.
    alone = spark.createDataFrame([("d2", "ben")], USERS)
    st.refresh(ev.limit(0), sp, sold.limit(0), alone)
    same(st.mart(), full(ev, sp, sold, alone))


def test_moving_lookback_drops_and_rebuilds(spark):
    cfg = AttributionConfig(lookback_days=10, attribution_window_days=5, as_of="2024-01-20 00:00:00")
    ev, sp = visits(spark, [(1, "a", "s1", dt(2024, 1, 6)), (2, "a", "s1", dt(2024, 1, 11)), (3, "a", "s2", dt(2024, 1, 13)),
                            (4, "b", "s3", dt(2024, 1, 6))])
    sold = sales(spark, [(10, "a", "s9", dt(2024, 1, 10, 12)), (11, "a", "s9", dt(2024, 1, 14)), (12, "b", "s3", dt(2024, 1, 10, 6))])
    nobody = spark.createDataFrame([], USERS)
    st = store(spark, cfg)
    st.refresh(ev, sp, sold, nobody)
    same(st.mart(), full(ev, sp, sold, nobody, cfg))
    later = cfg.but(as_of="2024-01-23 00:00:00")
    st.refresh(ev.limit(0), sp, sold.limit(0), nobody, history=(ev, sp), as_of=later.as_of)
    same(st.mart(), full(ev, sp, sold, nobody, later))
    same(st.touchpoints(), touchpoints.touchpoints(ev, sp, nobody, later))
    assert st.mart().filter("user_id = 'b'").isEmpty()


def test_random_batches_equal_full_recomputation(spark):
    t = star(spark, SF)
    part = F.pmod(F.hash("session_id", F.lit(1)), F.lit(3))
    st = store(spark)
    for i in range(3):
        # Arrival order has nothing to do with time.
        known = t["users"].filter(F.pmod(F.hash("id"), F.lit(4)) <= i + 1)
        st.refresh(t["events"].filter(part == i), t["source_properties"], t["custom_events"].filter(part == i), known)
    same(st.touchpoints(), touchpoints.touchpoints(t["events"], t["source_properties"], t["users"], CFG))
    same(st.conversions(), conversions.conversions(t["custom_events"], t["users"], CFG))
    want = full(t["events"], t["source_properties"], t["custom_events"], t["users"])
    same(st.mart(), want)


def test_row_changes_counts_duplicates_and_nulls(spark):
    old = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    new = spark.createDataFrame([("a", None), ("c", 2)], "x string, y int")
    assert rows(row_changes(old, new)) == [(1, 2, 1)]
    assert rows(row_changes(old.limit(0), old.limit(0))) == [(0, 0, 0)]


def test_price_keeps_cents(spark):
    ev, sp = visits(spark, [(1, "d", "s1", dt(2024, 1, 1))])
    sold = spark.createDataFrame([(9, "d", "s1", dt(2024, 1, 2), "Checkout Success", '{"price":"12.99"}')], CUSTOM)
    st = store(spark)
    st.refresh(ev, sp, sold, spark.createDataFrame([], USERS))
    assert st.conversions().first()["conversion_revenue"] == Decimal("12.99")


def small(spark):
    ev, sp = visits(spark, [(1, "d1", "s1", dt(2024, 1, 1)), (2, "d2", "s2", dt(2024, 1, 5)), (3, "d3", "s3", dt(2024, 1, 6))])
    sold = sales(spark, [(10, "d2", "s9", dt(2024, 1, 8)), (11, "d3", "s9", dt(2024, 1, 9))])
    return ev, sp, sold


@pytest.mark.parametrize("step", ["_merge_conversions", "_rebuild_mart"])
def test_run_after_a_crash_takes_up_what_was_left(spark, monkeypatch, step):
    ev, sp, sold = small(spark)
    st = store(spark)
    st.refresh(ev, sp, sold, spark.createDataFrame([("d2", "anna")], USERS))
    both = spark.createDataFrame([("d1", "anna"), ("d2", "anna")], USERS)
    more = sales(spark, [(12, "d1", "s8", dt(2024, 1, 3))])

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(st, step, crash)
        with pytest.raises(RuntimeError):
            st.refresh(ev.limit(0), sp, more, both)
    # The same batch again, or only the next one.
    st.refresh(ev.limit(0), sp, more, both)
    same(st.mart(), full(ev, sp, sold.union(more), both))
    assert rows(st.refresh(ev.limit(0), sp, more.limit(0), both))[0][:2] == (0, 0)


def test_crash_before_the_mart_is_mended_by_an_empty_batch(spark, monkeypatch):
    ev, sp, sold = small(spark)
    st, nobody = store(spark), spark.createDataFrame([], USERS)
    with monkeypatch.context() as broken:
        broken.setattr(st, "_rebuild_mart", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            st.refresh(ev, sp, sold, nobody)
    assert st.mart().count() == 0
    st.refresh(ev.limit(0), sp, sold.limit(0), nobody)
    same(st.mart(), full(ev, sp, sold, nobody))


def test_open_as_of_needs_history(spark):
    ev, sp, sold = small(spark)
    st, nobody = store(spark, AttributionConfig(lookback_days=36500)), spark.createDataFrame([], USERS)
    with pytest.raises(ValueError, match="history"):
        st.refresh(ev, sp, sold, nobody)
    st.refresh(ev, sp, sold, nobody, history=(ev, sp))
    assert st.cfg.as_of is None
    same(st.mart(), full(ev, sp, sold, nobody, AttributionConfig(lookback_days=36500)))


def test_late_event_opens_only_its_day(spark):
    ev, sp = visits(spark, [(i, "d", f"s{i}", dt(2024, 1, 1 + i)) for i in range(10)])
    batch = ev.filter("id in (0, 8, 9)")
    assert rows(same_time_range(batch, sp).select("event_id"), "event_id") == [(0,), (8,), (9,)]


def stored_rows(st):
    return {n: sorted(map(repr, st.read(n).collect())) for n in ("device_touchpoints", "device_conversions", "identities", "mart")}


class Lost(RuntimeError):
    pass


@pytest.mark.parametrize("table", ["identities", "device_touchpoints", "device_conversions", "mart", None])
def test_crash_inside_the_commit_shows_nothing_of_it(spark, monkeypatch, table):
    """Stopped after a table's new files are written, or after all are and before the swap."""
    ev, sp, sold = small(spark)
    st = store(spark)
    st.refresh(ev, sp, sold, spark.createDataFrame([("d2", "anna")], USERS))
    both = spark.createDataFrame([("d1", "anna"), ("d3", "ben")], USERS)
    more, late = sales(spark, [(12, "d1", "s8", dt(2024, 1, 8))]), visits(spark, [(4, "d1", "s1", dt(2024, 1, 7))])[0]
    sp2 = sp.unionByName(visits(spark, [(4, "d1", "s1", dt(2024, 1, 7))])[1])
    before = stored_rows(st)
    write, commit, commits = st.tables.write, st.tables.commit, []

    def written(name, *args, **kw):
        out = write(name, *args, **kw)
        if name == table:
            raise Lost
        return out

    def committed(snapshot):
        commits.append(snapshot)
        if table is None and len(commits) == 2:
            raise Lost
        return commit(snapshot)

    with monkeypatch.context() as broken:
        broken.setattr(st.tables, "write", written)
        broken.setattr(st.tables, "commit", committed)
        with pytest.raises(Lost):
            st.refresh(late, sp2, more, both)
    assert stored_rows(st) == before
    # A new process finds the noted batch; what was written for nothing goes with the next vacuum.
    again = AttributionStore(spark, st.root, CFG, buckets=4)
    again.refresh(late.limit(0), sp2, more.limit(0), both)
    same(again.mart(), full(ev.union(late), sp2, sold.union(more), both))
    assert again.vacuum(keep=1) > 0
    same(again.mart(), full(ev.union(late), sp2, sold.union(more), both))


def test_reader_keeps_its_version_and_a_second_writer_is_refused(spark):
    ev, sp, sold = small(spark)
    st, nobody = store(spark), spark.createDataFrame([], USERS)
    st.refresh(ev, sp, sold, nobody)
    old = st.tables.snapshot()
    reader, wanted = st.read("mart", old), rows(st.mart(), "user_id", "converted_at", "attribution_model")
    st.refresh(ev.limit(0), sp, sales(spark, [(12, "d1", "s8", dt(2024, 1, 3))]), nobody)
    assert rows(reader, "user_id", "converted_at", "attribution_model") == wanted != rows(st.mart(), "user_id", "converted_at", "attribution_model")
    with pytest.raises(Conflict):
        st.tables.commit(old)


def test_a_days_batch_writes_touched_days_only(spark):
    days = range(1, 11)
    ev, sp = visits(spark, [(i, f"d{i % 3}", f"s{i}", dt(2024, 1, i, 9)) for i in days])
    sold = sales(spark, [(100 + i, f"d{i % 3}", f"s{i}", dt(2024, 1, i, 12)) for i in days])
    nobody = spark.createDataFrame([], USERS)
    st = store(spark)
    st.refresh(ev, sp, sold, nobody)
    before = st.tables.snapshot()
    new_ev, new_sp = visits(spark, [(50, "d1", "s50", dt(2024, 1, 11, 9))])
    st.refresh(new_ev, sp.unionByName(new_sp), sales(spark, [(150, "d1", "s50", dt(2024, 1, 11, 12))]), nobody)
    after = st.tables.snapshot()
    for name in ("device_touchpoints", "device_conversions", "mart"):
        changed = {p for p in {**before.parts(name), **after.parts(name)} if before.parts(name).get(p) != after.parts(name).get(p)}
        assert changed == {"2024-01-11"}, name
    # A batch that brings nothing new writes no day at all.
    st.refresh(new_ev, sp.unionByName(new_sp), new_ev.limit(0).selectExpr("id event_id", "user_id", "session_id", "event_time", "'' event_name", "'' event_properties"), nobody)
    again = st.tables.snapshot()
    assert again.parts("mart") == after.parts("mart")
    same(st.mart(), full(ev.union(new_ev), sp.unionByName(new_sp), sold.union(sales(spark, [(150, "d1", "s50", dt(2024, 1, 11, 12))])), nobody))


def test_expiry_drops_days_without_reading_the_rest(spark):
    cfg = AttributionConfig(lookback_days=10, attribution_window_days=5, as_of="2024-01-20 06:00:00")
    ev, sp = visits(spark, [(i, "ab"[i % 2], f"s{i // 2}", dt(2024, 1, 3 + i // 2, 3 + i % 20)) for i in range(34)])
    sold = sales(spark, [(100 + i, "ab"[i % 2], f"s{i}", dt(2024, 1, 9 + i, 4 + i)) for i in range(11)])
    nobody = spark.createDataFrame([], USERS)
    st = store(spark, cfg)
    st.refresh(ev, sp, sold, nobody)
    before = st.tables.snapshot()
    later = cfg.but(as_of="2024-01-22 08:30:00")
    st.refresh(ev.limit(0), sp, sold.limit(0), nobody, history=(ev, sp), as_of=later.as_of)
    after = st.tables.snapshot()
    same(st.touchpoints(), touchpoints.touchpoints(ev, sp, nobody, later))
    same(st.conversions(), conversions.conversions(sold, nobody, later))
    same(st.mart(), full(ev, sp, sold, nobody, later))
    kept = [d for d in after.parts("device_touchpoints") if d > "2024-01-07"]
    assert min(after.parts("device_touchpoints")) == "2024-01-07"
    assert all(after.parts("device_touchpoints")[d] == before.parts("device_touchpoints")[d] for d in kept)
    assert all(after.parts("device_conversions")[d] == before.parts("device_conversions")[d] for d in after.parts("device_conversions") if d > "2024-01-12")


CHANGING = "id string, uid string, last_updated_time timestamp, deleted boolean"


def test_users_by_cursor(spark):
    """Only rows changed since the last refresh are noted; the result is that of a full build."""
    ev, sp, sold = small(spark)
    st = AttributionStore(spark, work_path(spark, "store"), CFG, buckets=4, users_by_cursor=True)
    people = [("d1", None, dt(2024, 1, 1), False), ("d2", "anna", dt(2024, 1, 2), False), ("d3", "ben", dt(2024, 1, 3), None), (None, "x", dt(2024, 1, 3), False)]
    users = spark.createDataFrame(people, CHANGING)
    st.refresh(ev, sp, sold, users)
    same(st.mart(), full(ev, sp, sold, users.filter("id is not null")))
    assert st.tables.snapshot().notes["users_seen"].startswith("2024-01-03")
    noted, write = [], st.tables.write

    def counting(name, frame, *args, **kw):
        if name == "noted_users":
            noted.append(sorted(r["device_id"] for r in frame.collect()))
        return write(name, frame, *args, **kw)

    st.tables.write = counting
    # d1 is identified, d2 moves, d3 is deleted; d2's old row stands beside the new one.
    people += [("d1", "anna", dt(2024, 1, 4), False), ("d2", "ben", dt(2024, 1, 5), False), ("d3", "ben", dt(2024, 1, 6), True)]
    st.refresh(ev.limit(0), sp, sold.limit(0), spark.createDataFrame(people, CHANGING))
    same(st.mart(), full(ev, sp, sold, spark.createDataFrame([("d1", "anna"), ("d2", "ben")], USERS)))
    st.refresh(ev.limit(0), sp, sold.limit(0), spark.createDataFrame(people, CHANGING))
    assert noted == [["d1", "d2", "d3"], ["d3"]]
    same(st.mart(), full(ev, sp, sold, spark.createDataFrame([("d1", "anna"), ("d2", "ben")], USERS)))


def test_bounded_sessions_give_the_same(spark):
    t = star(spark, SF)
    st = AttributionStore(spark, work_path(spark, "store"), CFG, buckets=4, session_days=40)
    for cond in (F.dayofmonth("event_time") <= 20, F.dayofmonth("event_time") > 20):
        st.refresh(t["events"].filter(cond), t["source_properties"], t["custom_events"].filter(cond), t["users"])
    same(st.mart(), full(t["events"], t["source_properties"], t["custom_events"], t["users"]))


def test_a_noted_batch_is_written_by_many_tasks(spark):
    """One task would write, and later read, the whole batch."""
    ev, sp = visits(spark, [(i, f"d{i}", f"s{i}", dt(2024, 1, 1 + i % 5)) for i in range(60)])
    sold = sales(spark, [(1000 + i, f"d{i}", f"s{i}", dt(2024, 1, 9)) for i in range(60)]).repartition(4)
    st = store(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        noted = st._note(st.tables.snapshot(), ev, sp, sold, spark.createDataFrame([(f"d{i}", f"u{i}") for i in range(60)], USERS))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name, n in (("noted_touchpoints", 60), ("noted_conversions", 60), ("noted_users", 60)):
        assert len(noted.parts(name)) == 1
        found = st.read(name, noted)
        assert found.count() == n and len(found.inputFiles()) > 1


def test_a_first_build_is_not_compared_with_nothing(spark, monkeypatch):
    ev, sp = visits(spark, [(1, "d", "s1", dt(2024, 1, 1))])
    nobody = spark.createDataFrame([], USERS)
    compared = []
    monkeypatch.setattr(refresh, "row_changes", lambda *a, **k: compared.append(1) or row_changes(*a, **k))
    st = store(spark)
    assert rows(st.refresh(ev, sp, sales(spark, [(2, "d", "s1", dt(2024, 1, 3))]), nobody)) == [(5, 0, 0)]
    assert not compared
    assert rows(st.refresh(ev.limit(0), sp, sales(spark, [(3, "d", "s1", dt(2024, 1, 2))]), nobody)) == [(5, 5, 0)]
    assert compared
