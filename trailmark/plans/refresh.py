"""Incremental refresh of the attribution tables.

What is stored is cut into parts so that a batch reads and rewrites little:

* ``device_touchpoints``, by day: the day's best signal per (session, device).  A batch combines by ``min``.
* ``device_conversions``, by day: conversion events.  A batch adds.
* ``identities``, by hash of the device: device to user as of the last refresh.
* ``mart``, by day of the conversion: the long attribution fact.

The first two do not depend on who a device belongs to, so a late identification only re-maps small rows.  What leaves the
lookback goes as whole days; only the day the cutoff falls on is filtered.  A refresh finds the users a batch touches
(new rows, changed identity, rows that left the lookback) and, per user, the earliest moment anything changed.
Conversions before it keep their paths; later ones are recomputed from the stored rows, compared with what stands, and only
days with a difference are written.  The result equals a full recomputation.

A refresh is two commits of a versioned store.  The first notes the batch, reduced to what the store needs, beside the tables;
the second swaps in all changed parts of all tables at once and strikes the batch out.  A reader sees the
tables before the batch or after it.  A run that follows a crash folds in what was noted, whether it brings the same
batch again or another.  The clock is read once per refresh.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.config import AttributionConfig, work_table
from trailmark.functions.combine import union_all
from trailmark.functions.time import Period, days_before
from trailmark.functions.traffic import signal_rank
from trailmark.operators import attribution, conversions, touchpoints
from trailmark.sources import staging
from trailmark.sources.versions import PART, Part, Snapshot, VersionedTables

_BEST = "struct<rank int, event_time timestamp, event_id {id}, source string, medium string, campaign string>"
_SCHEMAS = {
    "device_touchpoints": "session_id string, device_id string, best " + _BEST,
    "device_conversions": "device_id string, conversion_session_id string, converted_at timestamp, "
                          "conversion_revenue decimal(38,{scale}), event_id {id}",
    "identities": "device_id string, user_id string",
    "mart": "user_id string, session_id string, session_start_time timestamp, converted_at timestamp, source string, "
            "medium string, campaign string, total_sessions_for_conversion long, session_number long, "
            "is_conversion_session boolean, attribution_model string, attributed_revenue double",
    # Users that a noted batch may have changed; a null user is no longer known.
    "noted_users": "device_id string, user_id string, changed_at timestamp",
}
_NOTED = ("noted_touchpoints", "noted_conversions", "noted_users")
_SCHEMAS["noted_touchpoints"], _SCHEMAS["noted_conversions"] = _SCHEMAS["device_touchpoints"], _SCHEMAS["device_conversions"]
ALWAYS = "0001-01-01 00:00:00"


def row_changes(old: DataFrame, new: DataFrame, by: Column | None = None) -> DataFrame:
    """inserted, deleted and unchanged row counts between two versions, duplicates counted; of each ``part`` if ``by`` is given.

    One aggregation over both; NULLs compare as equal.
    """
    signed = old.withColumn("_o", F.lit(1)).withColumn("_n", F.lit(0)).unionByName(
        new.withColumn("_o", F.lit(0)).withColumn("_n", F.lit(1)))
    per_row = signed.groupBy(*old.columns).agg(F.sum("_o").alias("_o"), F.sum("_n").alias("_n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return (per_row.groupBy(by.alias(PART)) if by is not None else per_row).agg(
        total(F.greatest(F.col("_n") - F.col("_o"), F.lit(0))).alias("inserted_rows"),
        total(F.greatest(F.col("_o") - F.col("_n"), F.lit(0))).alias("deleted_rows"),
        total(F.least("_o", "_n")).alias("unchanged_rows"),
    )


def day_of(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd")


def same_time_range(batch: DataFrame, context: DataFrame) -> DataFrame:
    """Cut a per-event table to the batch's days, so the scan skips the rest.

    Neighbouring days become one range; a single late event opens its own day and not all days since.
    """
    if "event_time" not in context.columns:
        return context
    found = batch.select(F.to_date("event_time").alias("day")).filter("day is not null").distinct().orderBy("day").collect()
    if not found:
        return context.limit(0)
    ranges: list[list[date]] = []
    for (day,) in found:  # as many rows as the batch has days
        if ranges and day == ranges[-1][1]:
            ranges[-1][1] = day + timedelta(days=1)
        else:
            ranges.append([day, day + timedelta(days=1)])
    at, moment = F.col("event_time"), lambda d: F.lit(d.isoformat()).cast("timestamp")
    return context.filter(reduce(or_, [(at >= moment(a)) & (at < moment(b)) for a, b in ranges]))


@dataclass
class AttributionStore:
    """The stored attribution tables under ``root``.

    ``buckets`` parts hold the identities, ``files_per_day`` tasks write a day.  With ``users_by_cursor`` a refresh looks only at rows of
    the user table whose ``last_updated_time`` is not before the newest one seen (or missing); the source must then set it
    with every change, and say what is gone by a null ``uid`` or a true ``deleted``.  Otherwise the whole user table is compared.
    ``session_days`` promises that no session goes on longer than that, which bounds the search for a session's earlier days.
    """

    spark: SparkSession
    root: str
    cfg: AttributionConfig
    buckets: int = 32
    files_per_day: int = 1
    event_id_type: str = "bigint"
    users_by_cursor: bool = False
    session_days: int | None = None

    def __post_init__(self) -> None:
        self.tables = VersionedTables(self.spark, self.root)

    def _schema(self, name: str) -> str:
        return _SCHEMAS[name].format(id=self.event_id_type, scale=self.cfg.price_scale)

    def read(self, name: str, snapshot: Snapshot | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """Stored rows of a version (the current one), of some parts only if given."""
        return self.tables.read(snapshot or self.tables.snapshot(), name, self._schema(name), parts)

    def _bucket(self, device: str = "device_id") -> Column:
        return F.pmod(F.hash(device), F.lit(self.buckets)).cast("string")

    # -- products ---------------------------------------------------------------------------

    def touchpoints(self) -> DataFrame:
        now = self.tables.snapshot()
        return touchpoints.identity_touchpoints(self.read("device_touchpoints", now), self._stored_users(now))

    def conversions(self) -> DataFrame:
        now = self.tables.snapshot()
        return conversions.ordered_conversions(
            work_table(touchpoints.with_identity(self.read("device_conversions", now), self._stored_users(now)), "stored-conversions"))

    def mart(self) -> DataFrame:
        return self.read("mart")

    def vacuum(self, keep: int = 2) -> int:
        """Remove the files of older versions."""
        return self.tables.vacuum(keep)

    def _stored_users(self, snapshot: Snapshot) -> DataFrame:
        return self.read("identities", snapshot).select(F.col("device_id").alias("id"), F.col("user_id").alias("uid"))

    # -- refresh ----------------------------------------------------------------------------

    def refresh(
        self, events: DataFrame, source_properties: DataFrame, custom_events: DataFrame, users: DataFrame,
        history: tuple[DataFrame, DataFrame] | None = None, as_of: str | None = None,
    ) -> DataFrame:
        """Fold a batch in and return inserted, deleted and unchanged mart rows.

        ``events`` and ``custom_events`` are the new rows; ``source_properties`` may be the whole
        table, it is cut to the batch's days.  ``users`` is the current user table.  Where the lookback can
        move (``as_of`` is given, or the store's own is open and means now), sessions cut by it are
        rebuilt from ``history`` (all events and their context rows), which is then required.
        """
        configured = self.cfg
        moved = as_of is not None or configured.as_of is None
        if moved and history is None:
            raise ValueError("the lookback can move: pass history, or sessions it cuts would lose their later events")
        if as_of is not None:
            configured = configured.but(as_of=as_of)
        if configured.as_of is None:
            # One reading of the clock for all jobs of this refresh.
            now = self.spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
            self.cfg = configured.but(as_of=now)
        else:
            self.cfg = configured
        try:
            return self._refresh(events, source_properties, custom_events, users, history if moved else None)
        finally:
            self.cfg = configured

    def _refresh(
        self, events: DataFrame, source_properties: DataFrame, custom_events: DataFrame, users: DataFrame,
        history: tuple[DataFrame, DataFrame] | None,
    ) -> DataFrame:
        base = self._note(self.tables.snapshot(), events, source_properties, custom_events, users)
        fresh, sold, noted = (self.read(f"noted_{n}", base) for n in ("touchpoints", "conversions", "users"))
        found = self._noted_parts(fresh, sold, noted)
        changed = self._identity_changes(base, noted, found["user"])
        touch_cut, sale_cut = self._cutoffs() if history is not None else (None, None)
        expired = self._expired_touchpoints(base, touch_cut) if touch_cut else None
        after = self._merge_identities(base, changed, found["user"])
        after = self._merge_touchpoints(after, fresh, found["touch"], touch_cut, expired, history)
        after = self._merge_conversions(after, sold, found["sale"], sale_cut)
        affected = work_table(self._affected_users(
            base, after, fresh, sold, changed if found["user"] else None, found["touch"], expired, sale_cut), "affected")
        after, report = self._rebuild_mart(after, affected)
        for name in _NOTED:
            after = after.but(name, dict.fromkeys(after.parts(name)))
        self.tables.commit(after.noting(users_seen=max(found["seen"])) if found["seen"] else after)
        return self.spark.createDataFrame([report], "inserted_rows long, deleted_rows long, unchanged_rows long")

    def _note(
        self, base: Snapshot, events: DataFrame, source_properties: DataFrame, custom_events: DataFrame, users: DataFrame,
    ) -> Snapshot:
        """First commit: the batch, reduced, stands beside the tables as one part of the noted ones."""
        batch = uuid.uuid4().hex
        sp = same_time_range(events, source_properties)
        kept = {
            "noted_touchpoints": self._by_day(touchpoints.classified_events(events, sp, self.cfg)),
            "noted_conversions": conversions.device_conversions(custom_events, self.cfg),
            "noted_users": self._user_rows(base, users),
        }
        # The user table is always the current one, so an older batch's rows of it no longer count.
        noted = base.but("noted_users", dict.fromkeys(base.parts("noted_users")))
        for name, rows in kept.items():
            # One part, however large the batch: the tasks that made its rows write them.
            noted = noted.but(name, self.tables.write(name, rows.withColumn(PART, F.lit(batch)), files=None))
        return self.tables.commit(noted)

    def _by_day(self, classified: DataFrame) -> DataFrame:
        best = F.struct(signal_rank(F.col("medium")).alias("rank"), "event_time", "event_id", "source", "medium", "campaign")
        rows = classified.select("session_id", "device_id", day_of(F.col("event_time")).alias("_day"), best.alias("best"))
        return rows.groupBy("session_id", "device_id", "_day").agg(F.min("best").alias("best")).drop("_day")

    def _user_rows(self, base: Snapshot, users: DataFrame) -> DataFrame:
        """(device_id, user_id) that may differ from the stored ones."""
        if not self.users_by_cursor:
            now = staging.stage_users(users)
            both = now.select("device_id", F.col("user_id").alias("new"), F.lit(None).cast("string").alias("old")).unionByName(
                self.read("identities", base).select("device_id", F.lit(None).cast("string").alias("new"), F.col("user_id").alias("old")))
            per_device = both.groupBy("device_id").agg(F.max("old").alias("old"), F.max("new").alias("new"))
            return per_device.filter(~F.col("old").eqNullSafe(F.col("new"))).select(
                "device_id", F.col("new").alias("user_id"), F.lit(None).cast("timestamp").alias("changed_at"))
        at = F.col("last_updated_time")
        seen = base.notes.get("users_seen")
        rows = users if seen is None else users.filter((at >= F.lit(seen).cast("timestamp")) | at.isNull())
        gone = F.col("deleted") if "deleted" in users.columns else F.lit(False)
        user = F.when(~F.coalesce(gone, F.lit(False)), F.col("uid"))
        return rows.filter(F.col("id").isNotNull()).groupBy(F.col("id").alias("device_id")).agg(
            F.max_by(F.struct(user.alias("u")), F.struct(at, user))["u"].alias("user_id"), F.max(at).alias("changed_at"))

    def _noted_parts(self, fresh: DataFrame, sold: DataFrame, noted: DataFrame) -> dict[str, list[str]]:
        """Days and buckets the noted rows fall on, and the newest change of a user: as many rows as there are parts."""
        no_time = F.lit(None).cast("timestamp").alias("at")
        rows = (
            fresh.select(F.lit("touch").alias("kind"), day_of(F.col("best.event_time")).alias(PART), no_time)
            .union(sold.select(F.lit("sale"), day_of(F.col("converted_at")), no_time))
            .union(noted.select(F.lit("user"), self._bucket(), "changed_at"))
        )
        found: dict[str, list[str]] = {"touch": [], "sale": [], "user": [], "seen": []}
        newest = F.date_format(F.max("at"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("newest")
        for row in rows.groupBy("kind", PART).agg(newest).collect():
            found[row["kind"]].append(row[PART])
            if row["newest"]:
                found["seen"].append(row["newest"])
        return found

    # -- the parts of a refresh ---------------------------------------------------------------

    def _changes(self, name: str, rows: DataFrame, parts: Iterable[str], counted: dict[str, int] | None = None) -> dict[str, Part | None]:
        """Written parts of a table; a part without rows goes."""
        written = self.tables.write(name, rows, self.files_per_day, counted)
        return {p: written.get(p) for p in parts}

    def _identity_changes(self, base: Snapshot, noted: DataFrame, buckets: list[str]) -> DataFrame:
        """(device_id, old, new, part) for devices whose user differs from the stored one; reads the buckets of noted devices."""
        old = self.read("identities", base, buckets).withColumnRenamed("user_id", "old")
        both = noted.select("device_id", F.col("user_id").alias("new")).join(old, "device_id", "left")
        rows = both.filter(~F.col("old").eqNullSafe(F.col("new"))).withColumn(PART, self._bucket())
        return work_table(rows, "identity-changes") if buckets else rows

    def _merge_identities(self, base: Snapshot, changed: DataFrame, buckets: list[str]) -> Snapshot:
        touched = [r[PART] for r in changed.select(PART).distinct().collect()] if buckets else []
        if not touched:
            return base
        kept = self.read("identities", base, touched).join(changed, "device_id", "left_anti")
        new = changed.filter("new is not null").select("device_id", F.col("new").alias("user_id"))
        return base.but("identities", self._changes("identities", kept.unionByName(new).withColumn(PART, self._bucket()), touched))

    def _touch_cutoff(self) -> Column:
        return days_before(self.cfg.now(), self.cfg.lookback_days + self.cfg.attribution_window_days)

    def _sale_cutoff(self) -> Column:
        return days_before(self.cfg.now(), self.cfg.lookback_days)

    def _cutoffs(self) -> tuple[str, str]:
        """The days the two cutoffs fall on."""
        return tuple(self.spark.range(1).select(day_of(self._touch_cutoff()), day_of(self._sale_cutoff())).first())

    def _expired_touchpoints(self, base: Snapshot, cut: str) -> DataFrame:
        """Stored rows that left the lookback; reads the days up to the cutoff."""
        old = self.read("device_touchpoints", base, [d for d in base.parts("device_touchpoints") if d <= cut])
        return work_table(old.filter(F.col("best.event_time") < self._touch_cutoff()).select(
            "session_id", "device_id", day_of(F.col("best.event_time")).alias("day")), "expired")

    def _merge_touchpoints(
        self, base: Snapshot, fresh: DataFrame, days: list[str], cut: str | None, expired: DataFrame | None,
        history: tuple[DataFrame, DataFrame] | None,
    ) -> Snapshot:
        held = base.parts("device_touchpoints")
        touched = set(days) | ({cut} & set(held) if cut else set())
        if not touched and not cut:
            return base
        rows = self.read("device_touchpoints", base, touched).unionByName(fresh)
        if cut:
            left = Period(start=self._touch_cutoff(), end=F.lit(cut).cast("timestamp") + F.make_dt_interval(F.lit(1)))
            # Sessions whose best signal of the cutoff's day has gone may have another later that day.
            keys = expired.filter(F.col("day") == cut).select("session_id", F.col("device_id").alias("user_id")).distinct()
            events, sp = history
            again = touchpoints.classified_events(
                events.filter(left.holds(F.col("event_time"))).join(keys, ["session_id", "user_id"], "left_semi"), sp, self.cfg)
            rows = rows.unionByName(self._by_day(again)).filter(F.col("best.event_time") >= self._touch_cutoff())
        day = day_of(F.col("best.event_time")).alias(PART)
        merged = rows.groupBy("session_id", "device_id", day).agg(F.min("best").alias("best"))
        gone = {d: None for d in held if cut and d < cut}
        columns = ["session_id", "device_id", "best", PART]
        return base.but("device_touchpoints", {**self._changes("device_touchpoints", merged.select(*columns), touched), **gone})

    def _merge_conversions(self, base: Snapshot, sold: DataFrame, days: list[str], cut: str | None) -> Snapshot:
        held = base.parts("device_conversions")
        touched = set(days) | ({cut} & set(held) if cut else set())
        if not touched and not cut:
            return base
        if len(base.parts("noted_conversions")) > 1:
            sold = sold.dropDuplicates(["event_id"])
        # A replayed batch brings the same events again.
        kept = self.read("device_conversions", base, touched).join(sold.select("event_id"), "event_id", "left_anti").select(*sold.columns)
        rows = kept.unionByName(sold)
        if cut:
            rows = rows.filter(F.col("converted_at") >= self._sale_cutoff())
        gone = {d: None for d in held if cut and d < cut}
        rows = rows.withColumn(PART, day_of(F.col("converted_at")))
        return base.but("device_conversions", {**self._changes("device_conversions", rows, touched), **gone})

    def _near_days(self, snapshot: Snapshot, first: str | None, last: str | None) -> list[str]:
        """Days of touchpoints that a session with rows from ``first`` to ``last`` can have rows on."""
        days = list(snapshot.parts("device_touchpoints"))
        if self.session_days is None or first is None:
            return days
        low = (date.fromisoformat(first) - timedelta(days=self.session_days)).isoformat()
        high = (date.fromisoformat(last) + timedelta(days=self.session_days)).isoformat()
        return [d for d in days if low <= d <= high]

    def _affected_users(
        self, base: Snapshot, after: Snapshot, fresh: DataFrame, sold: DataFrame, changed: DataFrame | None, days: list[str],
        expired: DataFrame | None, cut: str | None,
    ) -> DataFrame:
        """(user_id, since): users whose paths may differ, and from which moment.

        A touchpoint only bears on later conversions and a conversion on itself and later ones.  A
        session's touchpoint may move, so its stored times count as well as the new one.
        Expired rows and changed identities reopen the user's whole history.
        """
        always = F.lit(ALWAYS).cast("timestamp").alias("since")
        at = F.col("best.event_time").alias("since")
        rows = [fresh.select("device_id", at), sold.select("device_id", F.col("converted_at").alias("since"))]
        if days:
            near = self._near_days(base, min(days), max(days))
            sessions = fresh.select("session_id").distinct()
            rows.append(self.read("device_touchpoints", base, near).join(sessions, "session_id", "left_semi").select("device_id", at))
        if changed is not None:
            rows.append(changed.select("device_id", always))
        if expired is not None:
            # Of an expired touchpoint only what is left of its session can still lead to a conversion.
            sessions = expired.select("session_id").distinct()
            rows.append(self.read("device_touchpoints", after).join(sessions, "session_id", "left_semi").select("device_id", always))
            old = self.read("device_conversions", base, [d for d in base.parts("device_conversions") if d <= cut])
            rows.append(old.filter(F.col("converted_at") < self._sale_cutoff()).select("device_id", always))
        devices = union_all(rows).groupBy("device_id").agg(F.min("since").alias("since"))
        current = devices.join(self.read("identities", after), "device_id", "left").select(
            F.coalesce("user_id", "device_id").alias("user_id"), "since")
        if changed is not None:
            # Rows of a device that has just been identified still stand under the device's own id.
            current = current.union(changed.select(F.coalesce("old", "device_id").alias("user_id"), always))
        return current.groupBy("user_id").agg(F.min("since").alias("since"))

    def _rebuild_mart(self, after: Snapshot, affected: DataFrame) -> tuple[Snapshot, tuple[int, int, int]]:
        """The mart with the affected users' paths recomputed, and what that inserted, deleted and left."""
        held = after.parts("mart")
        total = sum(p.rows for p in held.values())
        span = affected.agg(F.count(F.lit(1)), day_of(F.min("since")), day_of(days_before(F.min("since"), self.cfg.attribution_window_days))).first()
        if not span[0]:
            return after, (0, 0, total)
        first, reach_day = (None, None) if span[1] <= ALWAYS[:10] else span[1:]
        from_day = lambda table, day: [d for d in after.parts(table) if day is None or d >= day]
        identities = self.read("identities", after)
        # Devices whose rows belong to an affected user: its known devices, or itself if anonymous.
        known = identities.join(affected, "user_id", "left_semi").select("device_id", "user_id")
        alone = affected.select(F.col("user_id").alias("device_id"), "user_id").join(identities.select("device_id"), "device_id", "left_anti")
        members = work_table(known.unionByName(alone), "members")
        users = members.select(F.col("device_id").alias("id"), F.col("user_id").alias("uid"))
        dated = lambda df: df.join(affected, "user_id")

        # Touchpoints that can reach a conversion at or after ``since``; a session's best may lie on an earlier day.
        near = from_day("device_touchpoints", reach_day)
        touch = self.read("device_touchpoints", after, near).join(members.select("device_id"), "device_id", "left_semi")
        before = set(self._near_days(after, reach_day, max(near, default=reach_day))) - set(near) if reach_day else set()
        if before:
            older = self.read("device_touchpoints", after, before).join(members.select("device_id"), "device_id", "left_semi")
            touch = touch.unionByName(older.join(touch.select("session_id").distinct(), "session_id", "left_semi"))
        reach = days_before(F.col("since"), self.cfg.attribution_window_days)
        tp = dated(touchpoints.identity_touchpoints(touch, users)).filter(F.col("event_time") >= reach).drop("since")
        # Conversions to recompute, and the one before them, which closes the first path if it lies inside the window.
        stored = self.read("device_conversions", after, from_day("device_conversions", reach_day))
        sales = work_table(dated(stored.join(members, "device_id")), "sales")
        early = F.col("converted_at") < F.col("since")
        last = sales.filter(early).groupBy("user_id").agg(F.max("converted_at").alias("converted_at"))
        needed = sales.filter(~early).unionByName(sales.join(last, ["user_id", "converted_at"], "left_semi"))
        # Ordering reads its input twice.
        cv = conversions.ordered_conversions(work_table(needed.drop("since"), "needed-sales"))
        paths = attribution.attribution_mart(work_table(tp, "touchpoints"), work_table(cv, "conversions"), self.cfg)
        open_again = F.col("converted_at") >= F.col("since")
        new = work_table(dated(paths).filter(open_again).select(*attribution.MART_COLUMNS), "new-mart")

        day = day_of(F.col("converted_at"))
        standing = from_day("mart", first)
        if standing:
            replaced = dated(self.read("mart", after, standing)).filter(open_again).select(*new.columns)
            compared = row_changes(replaced, new, by=day)
        else:  # nothing to compare with
            compared = new.groupBy(day.alias(PART)).agg(F.count(F.lit(1)).alias("inserted_rows"), F.lit(0).alias("deleted_rows"))
        changes = {r[PART]: r for r in compared.collect() if r["inserted_rows"] or r["deleted_rows"]}
        inserted, deleted = (sum(r[c] for r in changes.values()) for c in ("inserted_rows", "deleted_rows"))
        if changes:
            counted = {d: (held[d].rows if d in held else 0) + r["inserted_rows"] - r["deleted_rows"] for d, r in changes.items()}
            old = self.read("mart", after, changes).join(affected, "user_id", "left")
            kept = old.filter(~F.coalesce(open_again, F.lit(False))).select(*new.columns)
            rows = kept.unionByName(new.filter(day.isin(list(changes)))).withColumn(PART, day)
            after = after.but("mart", self._changes("mart", rows, changes, counted))
        return after, (inserted, deleted, total - deleted)
