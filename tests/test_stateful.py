import json
from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, same
from trailmark.config import AttributionConfig, work_path
from trailmark.operators import conversions
from trailmark.operators.touchpoints import with_identity
from trailmark.sources.landing import star
from trailmark.streaming import stateful

SCHEMA = "user_id string, conversion_session_id string, converted_at timestamp, conversion_revenue decimal(38,2), event_id bigint"
KEPT = conversions.COLUMNS


@pytest.fixture
def run(spark):
    stateful.use_rocksdb(spark)

    def go(arrivals, watermark, forget_days=400):
        """Each DataFrame is one arrival; returns (result, progress reports)."""
        source, out = work_path(spark, "arrivals"), work_path(spark, "ordered")
        checkpoint, reports = work_path(spark, "checkpoint"), []
        for rows in arrivals:
            rows.coalesce(1).write.mode("append").parquet(source)
            stream = stateful.conversions_in_order(spark.readStream.schema(SCHEMA).parquet(source), watermark, forget_days)
            # Every arrival is a run of its own, so each restart goes on from the checkpoint.
            q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            q.awaitTermination()
            reports += [json.loads(p.json) if hasattr(p, "json") else p for p in q.recentProgress]
        return spark.read.schema(stream.schema).parquet(out), reports

    yield go
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def end(spark, at):
    """A row of nobody in particular that moves the watermark on."""
    return spark.createDataFrame([("zz end", "s", at, None, -1)], SCHEMA)


def test_shuffled_arrivals_equal_batch(spark, run):
    t = star(spark, SF)
    cfg = AttributionConfig(as_of="2024-01-31 00:00:00")
    found = with_identity(conversions.device_conversions(t["custom_events"], cfg), t["users"]).select(*[c.split()[0] for c in SCHEMA.split(", ")])
    part = F.pmod(F.hash("event_id"), F.lit(3))
    got, reports = run([found.filter(part == i) for i in range(3)] + [end(spark, dt(2024, 6, 1))], "40 days")
    mine = got.filter("user_id <> 'zz end'")
    assert mine.filter("late").isEmpty()
    same(mine.select(*KEPT), conversions.ordered_conversions(found).select(*KEPT))


def test_late_rows_go_aside_and_state_falls(spark, run):
    day = lambda d, h=0: dt(2024, 1, 1) + timedelta(days=d, hours=h)
    row = lambda user, at, n: (user, f"s{n}", at, None, n)
    arrivals = [
        [row("a", day(3), 3), row("a", day(1), 1), row("b", day(2), 2)],
        [row("a", day(2), 4), row("a", day(20), 5)],  # 4 is out of order, but within the watermark
        [row("a", day(1, 5), 6), row("a", day(19), 7), row("a", day(20), 8)],  # 6 comes after its place was emitted; 8 ties with 5
        [row("c", day(60), 9)],
        [row("a", day(61), 10)],  # long after: numbering starts anew
        [row("c", day(200), 11)],
    ]
    got, reports = run([spark.createDataFrame(a, SCHEMA) for a in arrivals], "5 days", forget_days=30)
    rows = {r["event_id"]: r for r in got.collect()}
    order = lambda n: (rows[n]["previous_conversion_at"], rows[n]["conversion_index"], rows[n]["late"])
    assert [order(n) for n in (1, 4, 3)] == [(None, 1, False), (day(1), 2, False), (day(2), 3, False)]
    assert [order(n) for n in (7, 5, 8)] == [(day(3), 4, False), (day(19), 5, False), (day(20), 6, False)]
    assert order(6) == (None, None, True)
    assert order(2) == order(9) == order(10) == (None, 1, False)
    assert 11 not in rows  # the watermark has not passed it
    state = [p["stateOperators"][0]["numRowsTotal"] for p in reports if p["stateOperators"]]
    assert state[-1] < max(state)


def test_a_user_has_one_timer_and_few_messages():
    """Three arrivals, then the watermark passes all and the time to remember them: every row in order, nothing kept."""
    calls, timers, kept = [], [], {}

    class State:
        def __init__(self, name):
            self.name = name

        def __getattr__(self, call):
            def done(*value):
                calls.append((self.name, call))
                if call == "exists":
                    return self.name in kept
                if call == "get":
                    return kept.get(self.name) if self.name != "waiting" else iter(kept.get(self.name, []))
                if call == "appendList":
                    kept[self.name] = kept.get(self.name, []) + value[0]
                elif call == "clear":
                    kept.pop(self.name, None)
                else:
                    kept[self.name] = value[0]
            return done

    class Handle:
        getListState = getValueState = lambda self, name, schema: State(name)

        def registerTimer(self, at):
            calls.append(("timer", "register"))
            timers.append(at)

        def deleteTimer(self, at):
            calls.append(("timer", "delete"))
            timers.remove(at)

    class Now:
        getCurrentWatermarkInMs = lambda self: 900 * stateful.DAY_MILLIS

    user = stateful.InOrder("bigint", 400)
    user.init(Handle())
    for n in (2, 3, 1):
        row = {"at": n * 1_000_000, "event_id": n, "conversion_session_id": "s", "revenue": "1"}
        assert not list(user.handleInputRows(("a",), iter([row]), None))
    out = []
    while timers:
        at = min(timers)
        out += list(user.handleExpiredTimer(("a",), Now(), None))
        timers.remove(at)
    assert [(r["conversion_index"], r["event_id"]) for r in out] == [(1, 1), (2, 2), (3, 3)]
    assert not kept and len(calls) <= 16
