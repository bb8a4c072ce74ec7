"""Structured Streaming forms of the main tables.

Update-mode results are appended to a Parquet log with their batch number; ``latest`` reads the
newest row per key.  That keeps sinks append-only, restartable and off the driver.  ``UpdateLog.fold`` keeps the log short.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from trailmark.config import AttributionConfig
from trailmark.functions.time import days_before
from trailmark.operators.ordered import DAY, time_bucket
from trailmark.operators.sketches import LG_K, daily_sketches
from trailmark.plans.metrics import Metric, metric
from trailmark.plans.refresh import AttributionStore
from trailmark.sources.versions import PART, VersionedTables

_BATCH = "batch"
# Length of the time slices that bound streaming state.
SLICE = "1 day"


class UpdateLog:
    """Update-mode rows under ``path``, one folder a micro-batch, and what has been folded of them.

    ``fold`` merges batches that can no longer be replayed (all but the newest) into one file per time slice, keeping the newest
    version of each key; slices the batches do not touch stay as they are.  The fold is a version of its own store, swapped in
    at once, and says up to which batch it reaches.  Folders of batches go one fold later, so a reader that began with
    the former version still finds them.  The writer only ever adds newer folders, so both can run at the same time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: StructType):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.schema = StructType([*schema.fields, StructField(_BATCH, LongType())])
        self.names = [f.name for f in schema.fields]
        # Slices by the first time among the keys; without one there is one slice.
        times = [f.name for f in schema.fields if f.name in self.keys and f.dataType.typeName().startswith("timestamp")]
        self.slice = F.date_format(times[0], "yyyy-MM-dd") if times else F.lit("all")
        self.folded = VersionedTables(spark, f"{path}/_folded")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """A replayed batch overwrites its own folder, so restarts do not duplicate rows."""
        rows.write.mode("overwrite").parquet(f"{self.path}/{_BATCH}={batch_id}")

    def _batches(self, after: int, upto: int | None = None) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(self.path).filter(F.col(_BATCH) > after)
        return rows if upto is None else rows.filter(F.col(_BATCH) <= upto)

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [n for n in (*self.names, _BATCH) if n not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), _BATCH).alias("v"))
        return newest.select(*self.keys, "v.*").select(*self.names, _BATCH)

    def latest(self) -> DataFrame:
        """The newest version of each key: the fold and the batches behind it."""
        now = self.folded.snapshot()
        upto = now.notes.get("upto", -1)
        rows = self._batches(upto)
        if now.parts("rows"):
            rows = rows.unionByName(self.folded.read(now, "rows", self.schema))
        return self._newest(rows).drop(_BATCH)

    def fold(self) -> int:
        """Fold closed batches; returns how many.  One folder at a time may be folding."""
        now = self.folded.snapshot()
        upto = now.notes.get("upto", -1)
        ids = sorted(int(n.removeprefix(f"{_BATCH}=")) for n in self.folded.names_above() if n.startswith(f"{_BATCH}="))
        closed = [i for i in ids[:-1] if i > upto]
        if not closed:
            return 0
        new = self._batches(upto, closed[-1])
        # As many rows as there are slices.
        touched = [r[PART] for r in new.select(self.slice.alias(PART)).distinct().collect()]
        merged = self._newest(new.unionByName(self.folded.read(now, "rows", self.schema, touched))) if touched else None
        written = self.folded.write("rows", merged.withColumn(PART, self.slice)) if touched else {}
        self.folded.commit(now.but("rows", written).noting(upto=closed[-1]))
        self.folded.vacuum(keep=2)
        for i in ids:
            if i <= upto:
                self.folded.remove_above(f"{_BATCH}={i}")
        return len(closed)


def append_updates(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict, keys: Sequence[str] = (), fold_every: int | None = None,
) -> StreamingQuery:
    """Write update-mode output to a log with one folder per micro-batch, folded every so many batches if ``keys`` are given."""
    log = UpdateLog(stream.sparkSession, path, keys, stream.schema)

    def write(rows: DataFrame, batch_id: int) -> None:
        log.write(rows, batch_id)
        if keys and fold_every and batch_id % fold_every == fold_every - 1:
            log.fold()

    return (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def latest(spark: SparkSession, path: str, keys: Sequence[str], schema: StructType) -> DataFrame:
    """The newest version of each key in an update log."""
    return UpdateLog(spark, path, keys, schema).latest()


def best_signal_per_session(signals: DataFrame, watermark: str, slice_length: str = SLICE) -> DataFrame:
    """Running best touchpoint per (session, user, time slice) from classified rows
    (user_id, session_id, event_time, event_id, source, medium, campaign, rank).

    The slice belongs to the key so that the watermark drops state of slices that are over; ``best_of_slices``
    puts a session's slices together.
    """
    best = F.struct("rank", "event_time", "event_id", "source", "medium", "campaign")
    sliced = signals.withWatermark("event_time", watermark).groupBy(F.window("event_time", slice_length).alias("w"), "session_id", "user_id")
    return sliced.agg(F.min(best).alias("best")).select("session_id", "user_id", F.col("w.start").alias("slice"), "best.*")


def best_of_slices(slices: DataFrame) -> DataFrame:
    """One best touchpoint per (session, user) from the newest version of every slice."""
    best = F.struct("rank", "event_time", "event_id", "source", "medium", "campaign")
    return slices.groupBy("session_id", "user_id").agg(F.min(best).alias("best")).select(
        "session_id", "user_id", "best.event_time", "best.source", "best.medium", "best.campaign")


def refresh_on_arrival(
    events: DataFrame, store: AttributionStore,
    inputs: Callable[[DataFrame], tuple[DataFrame, DataFrame, DataFrame]],
    checkpoint: str, trigger: dict, history: Callable[[], tuple[DataFrame, DataFrame]] | None = None,
) -> StreamingQuery:
    """Keyed refresh of touchpoints, conversions and mart for every micro-batch of events.

    ``inputs`` returns the context rows, new custom events and users for a batch.  Users touched by
    a batch are recomputed whole, so late and out-of-order events end up exactly where a batch run
    would put them, which a purely stateful ``lag`` cannot do.  ``history`` (all events and their context
    rows so far) is needed unless the store's ``as_of`` is fixed.
    """

    def fold(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        try:
            store.refresh(batch, *inputs(batch), history=history() if history else None)
        finally:
            batch.unpersist()

    return (
        events.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def link_touchpoints(
    touch: DataFrame, conv: DataFrame, cfg: AttributionConfig, watermark: str
) -> DataFrame:
    """Stream-stream interval join of touchpoints and conversions.

    The key is (user, day), with each conversion repeated for the days its range covers, so one
    busy user's state and comparisons are split by day.  Rows later than the watermark are lost,
    so it must cover the disorder of the inputs.
    """
    t = touch.withWatermark("event_time", watermark).withColumn("day", time_bucket(F.col("event_time"), DAY))
    oldest = days_before(F.col("converted_at"), cfg.attribution_window_days)
    lower = F.greatest(oldest, F.coalesce("previous_conversion_at", oldest))
    c = (
        conv.withWatermark("converted_at", watermark).withColumn("valid_from", lower)
        .filter(F.col("valid_from") < F.col("converted_at"))
        .withColumn("conv_day", F.explode(F.sequence(time_bucket(F.col("valid_from"), DAY), time_bucket(F.col("converted_at"), DAY))))
        .select(F.col("user_id").alias("conv_user"), "conv_day", "valid_from", "converted_at", "conversion_revenue")
    )
    window = F.expr(f"INTERVAL {int(cfg.attribution_window_days)} DAYS")
    on: Column = (
        (F.col("user_id") == F.col("conv_user")) & (F.col("day") == F.col("conv_day"))
        & (F.col("event_time") < F.col("converted_at")) & (F.col("event_time") >= F.col("converted_at") - window)
        & (F.col("event_time") >= F.col("valid_from"))
    )
    return t.join(c, on).select(
        "user_id", "session_id", F.col("event_time").alias("session_start_time"), "source", "medium", "campaign",
        "converted_at", "conversion_revenue")


def running_funnel(hits: DataFrame, n_steps: int, watermark: str, slice_length: str = SLICE) -> DataFrame:
    """First time of every step per (user, session, time slice) as events arrive.

    State of slices behind the watermark is dropped; ``first_of_slices`` puts a session's slices together.
    """
    sliced = hits.withWatermark("event_time", watermark).groupBy(F.window("event_time", slice_length).alias("w"), "user_id", "session_id")
    steps = range(1, n_steps + 1)
    firsts = sliced.agg(*[F.min(F.when(F.col("step") == i, F.col("event_time"))).alias(f"stp{i}_time") for i in steps])
    return firsts.select("user_id", "session_id", F.col("w.start").alias("slice"), *[f"stp{i}_time" for i in steps])


def first_of_slices(slices: DataFrame, n_steps: int) -> DataFrame:
    """First time of every step per (user, session); ``funnel.reached`` reads it."""
    return slices.groupBy("user_id", "session_id").agg(*[F.min(f"stp{i}_time").alias(f"stp{i}_time") for i in range(1, n_steps + 1)])


def windowed_metrics(
    rows: DataFrame, names: Sequence[str | Metric], length: str, slide: str | None, watermark: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Metrics of one table per tumbling or sliding event-time window.

    Exact distinct counts cannot stream; use ``approx_count_distinct`` in an ad-hoc metric.
    """
    frame = F.window("event_time", length, slide) if slide else F.window("event_time", length)
    chosen = [metric(n) for n in names]
    out = rows.withWatermark("event_time", watermark).groupBy(frame.alias("w"), *by).agg(
        *[F.expr(m.sql).alias(m.name) for m in chosen])
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                      *[m.name for m in chosen])


def sketch_on_arrival(
    stream: DataFrame, who: str, time: str, path: str, checkpoint: str, trigger: dict, by: Sequence[str] = (), lg_k: int = LG_K,
) -> StreamingQuery:
    """Keep day sketches of ``who`` under ``path``, a few rows a micro-batch, for ``operators.sketches`` to merge.

    No state and no watermark are needed: a day's late events come as one more sketch of that day, and a replayed batch
    overwrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        daily_sketches(batch, who, time, by, lg_k).write.mode("overwrite").parquet(f"{path}/{_BATCH}={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
