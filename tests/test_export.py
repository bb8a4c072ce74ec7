import json
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trailmark.config import work_path
from trailmark.operators.export import (
    MOST_WAVES, chunked_payloads, export_updated_user_properties, export_user_properties, exportable, numbered_in_order, round_of, wave_of,
    write_outbox,
)
from trailmark.operators.properties import custom_columns, property_profile
from trailmark.sources.state import Cursor, SyncState

USERS = "uid string, loyalty_tier string, updated_at timestamp"


def users(spark, n=25, ties=5):
    """``ties`` users share each timestamp; one has no uid and one an empty one."""
    data = [(f"u{i:03d}", "gold" if i % 2 else None, dt(2024, 1, 1 + i // ties)) for i in range(n)]
    return spark.createDataFrame([*data, (None, "x", dt(2024, 1, 2)), ("", "x", dt(2024, 1, 2))], USERS)


def state(spark):
    return SyncState(spark, work_path(spark, "state"))


def run(spark, st, df, transport, **kw):
    report, outbox = export_updated_user_properties(df, st, batch_size=4, transport=transport, **kw)
    return report.first(), outbox


def accept(payload):
    return 202, "accepted"


def refuse(uid):
    return lambda payload: (500, "x" * 900) if f'"{uid}"' in payload else (200, "")


def uids(outbox):
    return [u["uid"] for r in outbox.orderBy("chunk_id").collect() for u in json.loads(r["payload"])["requests"]]


def test_payload_shape(spark):
    report, outbox = run(spark, state(spark), users(spark), accept)
    first = json.loads(outbox.filter("chunk_id = 0").first()["payload"])
    assert first["requests"][1] == {"uid": "u001", "properties": {"loyalty_tier": "gold", "warehouse_synced_at": "2024-01-01 00:00:00"}}
    assert uids(outbox) == [f"u{i:03d}" for i in range(25)]
    assert (report["status"], report["chunks_pushed"], report["users_pushed"]) == ("ok", 7, 25)


def test_second_run_has_no_updates(spark):
    st = state(spark)
    run(spark, st, users(spark), accept)
    report, _ = run(spark, st, users(spark), accept)
    assert (report["status"], report["chunks_pushed"]) == ("no_updates", 0)
    assert report["previous_watermark"] == report["new_watermark"] == dt(2024, 1, 5)


@pytest.mark.parametrize("wave", [1, 3, 16])
def test_failure_inside_a_tie_loses_nobody(spark, wave):
    st, df = state(spark), users(spark)
    report, outbox = run(spark, st, df, refuse("u012"), wave=wave)
    assert (report["status"], report["chunks_pushed"], report["users_pushed"]) == ("failed_mid_run", 3, 12)
    assert report["http_status"] == 500 and len(report["response"]) == 500
    report, outbox = run(spark, st, df, accept)
    assert report["status"] == "ok" and uids(outbox) == [f"u{i:03d}" for i in range(12, 25)]


def test_strict_timestamp_skips_tied_users(spark):
    st, df = state(spark), users(spark)
    run(spark, st, df, refuse("u012"), wave=1)
    _, outbox = run(spark, st, df, accept, strict_timestamp=True)
    assert uids(outbox) == [f"u{i:03d}" for i in range(15, 25)]


def test_failure_on_the_last_partial_chunk(spark):
    report, _ = run(spark, state(spark), users(spark), refuse("u024"))
    assert (report["status"], report["chunks_pushed"]) == ("failed_on_final_chunk", 6)


def test_first_chunk_failing_leaves_the_watermark(spark):
    st = state(spark)
    report, _ = run(spark, st, users(spark), refuse("u000"), wave=2)
    assert report["chunks_pushed"] == 0 and st.read("user_props") == Cursor("1970-01-01 00:00:00.000000", None)


def test_without_transport_the_outbox_is_the_delivery(spark):
    st = state(spark)
    report, outbox = run(spark, st, users(spark), None)
    assert report["users_pushed"] == 25 and st.read("user_props") == Cursor("2024-01-05 00:00:00.000000", "u024")


def test_one_time_push(spark):
    report, outbox = export_user_properties(users(spark), 10, {"warehouse_synced": True}, batch_size=4)
    assert uids(outbox) == [f"u{i:03d}" for i in range(10)] and report.first()["users_pushed"] == 10
    assert '"properties":{"warehouse_synced":true}' in outbox.first()["payload"]
    none, _ = export_user_properties(users(spark).filter("uid = ''"), 10, {"a": 1})
    assert none.first()["status"] == "no_users_found"
    bad, _ = export_user_properties(users(spark), 10, {"a": 1}, transport=refuse("u005"))
    assert bad.first()["status"] == "failed"


def test_numbering_equals_a_global_sort(spark):
    df = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("uid"),
                                  F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.hash("id"), F.lit(900))).alias("updated_at"))
    got = rows(numbered_in_order(df, ["updated_at", "uid"], "n").select("n", "updated_at", "uid"), "n")
    assert [g[0] for g in got] == list(range(5000)) and [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_empty_delta_has_no_chunks(spark):
    assert chunked_payloads(exportable(users(spark).limit(0)), F.struct("loyalty_tier")).isEmpty()


def test_state_seed_keeps_existing(spark):
    st = state(spark)
    st.seed("a")
    st.advance("a", Cursor("2024-01-03 00:00:00", "u"))
    st.seed("a")
    assert rows(st.table().select("sync_name", "last_uid")) == [("a", "u")]


def test_property_discovery(spark):
    df = spark.createDataFrame([("e1", None, "red", 3), ("e2", None, None, 3)], "EVENT_ID string, event_time timestamp, color string, slot int")
    assert custom_columns("element_properties", df) == ["color", "slot"]
    got = sorted(rows(property_profile({"element_properties": df}, exact=True)))
    assert got == [("element_properties", "color", "string", 1, 1), ("element_properties", "slot", "int", 2, 1)]


def test_a_wave_opens_only_its_own_files(spark):
    chunks = chunked_payloads(exportable(users(spark, 60)), F.struct("loyalty_tier"), 4)
    stored = write_outbox(chunks, work_path(spark, "outbox"), 3)
    assert rows(stored.drop("wave"), "chunk_id") == rows(chunks, "chunk_id")
    seen = []
    for number in range(5):
        one = wave_of(stored, number)
        read = one.select(F.col("chunk_id"), F.input_file_name().alias("file")).collect()
        assert sorted(r["chunk_id"] for r in read) == list(range(3 * number, 3 * number + 3))
        assert all(f"wave={number}/" in r["file"] for r in read)
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(wave" in plan
        seen += [r["chunk_id"] for r in read]
    assert sorted(seen) == list(range(15))


def test_each_payload_is_sent_once(spark, tmp_path):
    """Every payload leaves a file of its own; a second one for the same chunk would be refused."""
    folder = str(tmp_path)

    def note(payload):
        import hashlib
        import os

        os.close(os.open(f"{folder}/{hashlib.sha256(payload.encode()).hexdigest()}", os.O_CREAT | os.O_EXCL))
        return 200, "ok"

    report, _ = run(spark, state(spark), users(spark, 50), note, wave=3)
    assert (report["status"], report["chunks_pushed"], len(list(tmp_path.iterdir()))) == ("ok", 13, 13)
    sent = tmp_path / "once"
    sent.mkdir()
    folder = str(sent)
    report, _ = export_user_properties(users(spark, 50), 30, {"a": 1}, transport=note, batch_size=4)
    assert report.first()["chunks_pushed"] == 8 and len(list(sent.iterdir())) == 8


def test_rounds_double_up_to_a_bound(spark):
    most = MOST_WAVES
    got = rows(spark.range(5 * most).select(round_of(F.col("id")).alias("r")).groupBy("r").count(), "r")
    ramp = most.bit_length() - 1
    assert got == [(r, 1 << r) for r in range(ramp)] + [(ramp + i, most) for i in range(4)] + [(ramp + 4, 1)]


def test_jobs_and_watermark_steps_do_not_grow_with_the_waves(spark, tmp_path):
    """100 waves of one chunk: a watermark step and a folder a round, 7 of them, and none a wave."""
    path, outbox = str(tmp_path / "state"), str(tmp_path / "outbox")
    report, _ = run(spark, SyncState(spark, path), users(spark, 400, ties=20), accept, wave=1, outbox_path=outbox)
    assert (report["status"], report["chunks_pushed"], report["users_pushed"]) == ("ok", 100, 400)
    assert spark.read.parquet(path).count() == 1 + 7
    assert len(list((tmp_path / "outbox").glob("*=*"))) == 7


@pytest.mark.parametrize("wave", [1, 2, 3])
def test_a_failure_deep_in_a_run_sends_little_in_vain(spark, wave, tmp_path):
    """Of the failed round no more goes out than was delivered before it and a wave; nobody is lost or sent before the watermark."""
    folder, failing = str(tmp_path), "u130"

    def note(payload):
        import hashlib
        import os

        bad = f'"{failing}"' in payload
        os.close(os.open(f"{folder}/{hashlib.sha256(payload.encode()).hexdigest()}", os.O_CREAT | os.O_EXCL))
        return (500, "no") if bad else (200, "ok")

    st, df = state(spark), users(spark, 240, ties=20)
    report, _ = run(spark, st, df, note, wave=wave)
    assert (report["status"], report["chunks_pushed"], report["users_pushed"]) == ("failed_mid_run", 32, 128)
    assert 33 <= len(list(tmp_path.iterdir())) <= 2 * 32 + wave
    _, outbox = run(spark, st, df, accept, wave=wave)
    assert uids(outbox) == [f"u{i:03d}" for i in range(128, 240)]
