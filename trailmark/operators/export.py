"""Push user properties out: once for a sample, or incrementally behind a watermark."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.config import work_path, work_table
from trailmark.sources.state import Cursor, SyncState

BATCH_SIZE = 1000
_RESPONSE_CHARS = 500
_WAVE, _ROUND = "wave", "round"
# Most waves of a round: what a failure may send in vain and a crash may send again is bounded.
MOST_WAVES = 1024

# Delivers one JSON payload, returns (status code, response text).  Runs on executors.
Transport = Callable[[str], tuple[int, str]]


def exportable(users: DataFrame) -> DataFrame:
    return users.filter(F.col("uid").isNotNull() & (F.col("uid") != ""))


def after_cursor(users: DataFrame, cursor: Cursor, strict_timestamp: bool = False) -> DataFrame:
    """Users changed after the cursor.

    The cursor is (timestamp, uid): users tied on the timestamp of a chunk's end are still found
    after a failure.  ``strict_timestamp`` compares the timestamp alone.
    """
    at = F.lit(cursor.at).cast("timestamp")
    newer = F.col("updated_at") > at
    if not strict_timestamp and cursor.uid is not None:
        # The plain lower bound reaches the scan; the pair decides the tie.
        newer = (F.col("updated_at") >= at) & (newer | (F.col("uid") > cursor.uid))
    return users.filter(newer)


def numbered_in_order(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """0-based position in a total order, without one task sorting everything.

    Range partitions are sorted in place and written, which fixes each row's partition and place;
    one count per partition then gives every partition its offset.
    """
    place = F.monotonically_increasing_id()
    ordered = work_table(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place), "ordered"
    ).withColumn("_part", F.shiftright("_place", 33)).withColumn("_pos", F.col("_place").bitwiseAND((1 << 33) - 1))
    # One row per range partition: small by construction, so the window and the broadcast are safe.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.col("_pos")).drop("_place", "_part", "_pos", "_offset")
    )


def chunked_payloads(users: DataFrame, properties: Column, batch_size: int = BATCH_SIZE) -> DataFrame:
    """One JSON request per ``batch_size`` users, oldest change first.

    A chunk gathers at most ``batch_size`` rows, so the list in one row is bounded.
    """
    rows = numbered_in_order(users, ["updated_at", "uid"], "_n")
    user = F.struct(F.col("uid"), properties.alias("properties"))
    listed = F.sort_array(F.collect_list(F.struct("_n", user.alias("user"))))
    return (
        rows.groupBy(F.floor(F.col("_n") / F.lit(batch_size)).cast("long").alias("chunk_id"))
        .agg(F.count(F.lit(1)).alias("users"), F.max(F.struct("updated_at", "uid")).alias("end"),
             F.to_json(F.struct(F.transform(listed, lambda x: x["user"]).alias("requests"))).alias("payload"))
        .select("chunk_id", "users", "end.updated_at", "end.uid", "payload")
    )


def write_outbox(chunks: DataFrame, path: str, wave: int) -> DataFrame:
    """Write chunks in order, ``wave`` to a folder, and return the outbox as a reader sees it.

    The folder's name says which chunks it holds, so a wave opens its own folder and no other.
    """
    in_waves = chunks.withColumn(_WAVE, F.floor(F.col("chunk_id") / F.lit(wave)).cast("long"))
    in_waves.repartitionByRange(_WAVE).sortWithinPartitions("chunk_id").write.partitionBy(_WAVE).parquet(path)
    return chunks.sparkSession.read.schema(in_waves.schema).parquet(path)


def wave_of(outbox: DataFrame, number: int) -> DataFrame:
    """The chunks of one wave; a filter on the folder, so only its files are read."""
    return outbox.filter(F.col(_WAVE) == number)


def round_of(wave: Column) -> Column:
    """Round of a wave: rounds hold 1, 2, 4 ... ``MOST_WAVES`` waves, then ``MOST_WAVES`` each."""
    ramp = MOST_WAVES.bit_length() - 1
    growing = F.length(F.bin(wave + 1)) - 1
    return F.when(wave < MOST_WAVES - 1, growing).otherwise(ramp + F.floor((wave - (MOST_WAVES - 1)) / MOST_WAVES)).cast("long")


def write_rounds(chunks: DataFrame, path: str, wave: int) -> DataFrame:
    """Write chunks in order, a round of waves to a folder, so that folders do not grow with the chunks; returns them with ``round``."""
    in_rounds = chunks.withColumn(_ROUND, round_of(F.floor(F.col("chunk_id") / F.lit(wave)).cast("long")))
    in_rounds.repartitionByRange("chunk_id").sortWithinPartitions("chunk_id").write.partitionBy(_ROUND).parquet(path)
    return chunks.sparkSession.read.schema(in_rounds.schema).parquet(path)


def _sender(transport: Transport, kept: Sequence[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [transport(p) for p in batch["payload"]]
            yield batch[list(kept)].assign(http_status=[a[0] for a in answers], response=[a[1][:_RESPONSE_CHARS] for a in answers])

    return send


def push_chunks(chunks: DataFrame, transport: Transport, tasks: int) -> DataFrame:
    """Send chunks from executors; one status row per chunk, with what it held and where it ended."""
    kept = ["chunk_id", "users", *[c for c in ("at", "uid") if c in chunks.columns]]
    spread = chunks.select(*kept, "payload").repartitionByRange(tasks, "chunk_id")
    schema = "chunk_id long, users long, " + "".join(f"{c} string, " for c in kept[2:]) + "http_status int, response string"
    return spread.mapInPandas(_sender(transport, kept), schema)


def _is_good() -> Column:
    return (F.col("http_status") >= 200) & (F.col("http_status") < 300)


def _sender_in_order(transport: Transport, kept: Sequence[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stopped = False
        for batch in batches:
            answers = []
            for payload in batch["payload"]:
                if stopped:
                    break
                answers.append(transport(payload))
                stopped = not 200 <= answers[-1][0] < 300
            # What is left after a failure is read to the end and not sent.
            yield batch[list(kept)].head(len(answers)).assign(
                http_status=[a[0] for a in answers], response=[a[1][:_RESPONSE_CHARS] for a in answers])

    return send


def push_in_lanes(chunks: DataFrame, transport: Transport, lanes: int) -> DataFrame:
    """Send chunks from ``lanes`` tasks, each its own in order, up to its first failure.

    Chunk n goes by lane n modulo ``lanes``.  Every chunk before the first that failed of all has been delivered.
    One status row per chunk sent.
    """
    kept = ["chunk_id", "users", "at", "uid"]
    own = chunks.select(*kept, "payload").repartitionById(lanes, F.pmod("chunk_id", F.lit(lanes)).cast("int")).sortWithinPartitions("chunk_id")
    return own.mapInPandas(_sender_in_order(transport, kept), "chunk_id long, users long, at string, uid string, http_status int, response string")


def export_updated_user_properties(
    users: DataFrame, state: SyncState, sync_name: str = "user_props",
    properties: Sequence[str] = ("loyalty_tier",), batch_size: int = BATCH_SIZE,
    transport: Transport | None = None, wave: int = 16, strict_timestamp: bool = False,
    outbox_path: str | None = None, log_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Export users changed since the watermark.  Returns (run report, outbox).

    ``log_path`` collects the reports of all runs.

    Executors write all payloads to the outbox.  Without a transport that is the delivery and the
    watermark moves to its end.  With one, chunks go out in order, ``wave`` at a time, each by a lane of its own; the
    watermark follows the unbroken run of delivered chunks and the run stops at the first failure,
    so the next run resumes there.  A chunk may be sent twice after a failure, never skipped.

    Waves go in rounds of 1, 2, 4 ... ``MOST_WAVES``, a job and a step of the watermark each.  A lane stops at its own failure, the
    other lanes finish the round: at most a wave more than had been delivered before is sent in vain.
    Each payload is read once, by its round; statuses stay on executors, the driver sees the first failure and sums.
    """
    spark = users.sparkSession
    state.seed(sync_name)
    cursor = state.read(sync_name)
    delta = after_cursor(exportable(users), cursor, strict_timestamp).select("uid", "updated_at", *properties)
    bag = F.struct(*properties, F.col("updated_at").cast("string").alias("warehouse_synced_at"))
    path = outbox_path or work_path(spark, "outbox")
    stored = write_rounds(chunked_payloads(delta, bag, batch_size), path, wave)
    outbox = stored.drop(_ROUND)

    def end_of(chunks: DataFrame) -> tuple[int, int, Cursor]:
        end = F.max(F.struct("updated_at", "uid"))
        row = chunks.agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("users"), F.lit(0)).alias("users"),
            F.date_format(end["updated_at"], "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), end["uid"].alias("uid"),
        ).first()
        return row["n"], row["users"], Cursor(row["at"], row["uid"])

    def report(status: str, chunks: int, count: int, new: str | None, code: int | None = None, text: str | None = None):
        row = spark.range(1).select(
            F.lit(status).alias("status"), F.lit(chunks).cast("long").alias("chunks_pushed"),
            F.lit(count).cast("long").alias("users_pushed"),
            F.lit(cursor.at).cast("timestamp").alias("previous_watermark"),
            F.lit(new).cast("timestamp").alias("new_watermark"), F.lit(code).cast("int").alias("http_status"),
            F.lit(text).cast("string").alias("response"))
        if log_path:
            row.withColumn("finished_at", F.current_timestamp()).write.mode("append").parquet(log_path)
        return row, outbox

    total, all_users, end = end_of(outbox)
    if total == 0:
        return report("no_updates", 0, 0, cursor.at)
    if transport is None:
        state.advance(sync_name, end)
        return report("ok", total, all_users, end.at)

    at = F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
    pushed, sent, reached = 0, 0, cursor
    rounds = stored.agg(F.max(_ROUND).alias("last")).first()["last"] + 1
    for number in range(rounds):
        mine = stored.filter(F.col(_ROUND) == number).select("chunk_id", "users", at, "uid", "payload")
        # Written, so that reading the answers again does not send again.
        answers = work_table(push_in_lanes(mine, transport, wave), "answers")
        failed = answers.filter(~_is_good()).agg(F.min(F.struct("chunk_id", "users", "http_status", "response")).alias("f")).first()["f"]
        good = answers if failed is None else answers.filter(F.col("chunk_id") < failed["chunk_id"])
        done = good.agg(F.count(F.lit(1)).alias("n"), F.sum("users").alias("users"), F.max(F.struct("chunk_id", "at", "uid")).alias("end")).first()
        if done["n"]:
            reached = Cursor(done["end"]["at"], done["end"]["uid"])
            state.advance(sync_name, reached)
            sent += done["users"]
            pushed += done["n"]
        if failed is not None:
            last = failed["chunk_id"] == total - 1 and failed["users"] < batch_size
            status = "failed_on_final_chunk" if last else "failed_mid_run"
            return report(status, pushed, sent, reached.at, failed["http_status"], failed["response"])
    return report("ok", pushed, sent, end.at)


def export_user_properties(
    users: DataFrame, limit: int, properties: Mapping[str, Any], transport: Transport | None = None,
    batch_size: int = BATCH_SIZE, outbox_path: str | None = None, wave: int = 16,
) -> tuple[DataFrame, DataFrame]:
    """One-time push of a fixed property bag to the first ``limit`` users by uid.

    ``limit`` is the caller's sample size.  Returns (run report, outbox).
    """
    spark = users.sparkSession
    # Numbered over range partitions: a large limit does not end in one task.
    sample = numbered_in_order(exportable(users).select("uid"), ["uid"], "place").filter(F.col("place") < limit).select("uid")
    bag = F.struct(*[F.lit(v).alias(k) for k, v in properties.items()])
    path = outbox_path or work_path(spark, "outbox")
    rows = sample.withColumn("updated_at", F.lit(None).cast("timestamp"))
    outbox = write_outbox(chunked_payloads(rows, bag, batch_size).select("chunk_id", "users", "payload"), path, wave).drop(_WAVE)
    total = outbox.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("users"), F.lit(0)).alias("u")).first()
    if total["n"] == 0:
        status, code, text, sent, count = "no_users_found", None, None, 0, 0
    elif transport is None:
        status, code, text, sent, count = "ok", None, None, total["n"], total["u"]
    else:
        # Written, so that reading the answers again does not send again.
        answers = work_table(push_chunks(outbox, transport, total["n"]), "answers")
        good = (F.col("http_status") >= 200) & (F.col("http_status") < 300)
        first = answers.filter(~good).orderBy("chunk_id").limit(1).first()
        delivered = answers.filter(good).agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("users"), F.lit(0)).alias("u")).first()
        sent, count = delivered["n"], delivered["u"]
        status, code, text = ("ok", 200, None) if first is None else ("failed", first["http_status"], first["response"])
    report = spark.range(1).select(
        F.lit(status).alias("status"), F.lit(sent).cast("long").alias("chunks_pushed"),
        F.lit(count).cast("long").alias("users_pushed"), F.lit(code).cast("int").alias("http_status"),
        F.lit(text).cast("string").alias("response"))
    return report, outbox
