"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partition.

Records are ordered by (hash of the text, id), so equal texts lie together.  A sample of record keys,
each drawn with a chance in proportion to its size, gives ``ranges`` quantile boundaries; exact totals per
range are then counted.  A range that turns out overfull (many copies of one text share a key) is
subdivided at quantiles of the id.  Running sizes inside ranges plus the totals of the ranges before give
every record its exact place on one line of bytes, which is cut into shards of equal bytes: shard
sizes differ by about one record.  No range is ever ordered as a whole table, and only range totals
meet in one task.

A text whose copies together take at most ``whole_share`` of one shard stays in one shard; beyond that its copies
are split, so that sizes stay near equal however hot a text is.

Defined cases: a null text has size 1 and hashes like any other value; null ids sort first; repeated rows
get slots of their own (which of them gets which does not matter, they are equal); an empty table
gives no rows; other columns are carried along or left out by the caller.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.config import work_table

RANGES = 256
SAMPLE = 20_000
WHOLE_SHARE = 0.02


def splitters(records: DataFrame, ranges: int = RANGES, sample: int = SAMPLE) -> list[int]:
    """Boundaries on the key ``h`` from about ``sample`` size-weighted draws.

    A record of size s is drawn when a hash of it falls below s * sample / total, so a rerun draws the same.
    At most ``ranges`` values reach the driver.
    """
    total = records.agg(F.sum("size")).first()[0]
    if not total:
        return []
    u = (F.xxhash64(F.lit("draw"), "d", "h").bitwiseAND((1 << 52) - 1)) / float(1 << 52)
    drawn = records.filter(u < F.col("size") * F.lit(sample / total))
    cuts = drawn.agg(F.percentile_approx("h", F.array(*[F.lit(i / ranges) for i in range(1, ranges)]), 10_000)).first()[0]
    return sorted(set(cuts or []))


def place_in_ranges(records: DataFrame, ranges: int = RANGES, sample: int = SAMPLE) -> DataFrame:
    """``records`` with ``range`` (by key) and ``part`` (by ``d``, only where a range is overfull).

    A range is overfull with over twice the mean number of records, which happens where many records share a
    key; it is cut at quantiles of ``d``, so that order by (range, key, part, d) is order by (key, d).
    """
    cuts = splitters(records, ranges, sample)
    bounds = F.array(*[F.lit(c).cast("bigint") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    ranged = records.withColumn("range", F.size(F.filter(bounds, lambda c: c < F.col("h"))))
    sizes = {r["range"]: r["rows"] for r in ranged.groupBy("range").agg(F.count("*").alias("rows")).collect()}
    most = 2 * sum(sizes.values()) / (len(cuts) + 1)
    overfull = {r: math.ceil(n / (most / 2)) for r, n in sizes.items() if n > most}
    part = F.lit(0)
    if overfull:
        every = max(overfull.values())
        at = F.array(*[F.lit(i / every) for i in range(1, every)])
        subs = ranged.filter(F.col("range").isin(list(overfull))).groupBy("range").agg(F.percentile_approx("d", at, 10_000).alias("subs"))
        for r in subs.collect():  # as many values as there are parts in overfull ranges, about RANGES
            inner = F.array(*[F.lit(c).cast("bigint") for c in sorted(set(r["subs"] or []))])
            below = F.size(F.filter(inner, lambda c: c < F.col("d")))
            part = F.when(F.col("range") == r["range"], F.greatest(below, F.lit(0))).otherwise(part)
    return ranged.withColumn("part", part)


def ordered(records: DataFrame, ranges: int = RANGES, sample: int = SAMPLE) -> DataFrame:
    """``records`` with ``n_before``, ``b_before`` (of the record) and ``g_before``, ``g_bytes`` (of its text's copies)."""
    placed = work_table(place_in_ranges(records, ranges, sample), "shard-ranges")
    # A key's copies may be spread over the parts of one range: totals per (range, key, part) put them in line.
    runs = placed.groupBy("range", "h", "part").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    totals = runs.groupBy("range").agg(F.sum("n").alias("rn"), F.sum("b").alias("rb"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row per range, at most RANGES of them
    totals = totals.select("range", F.coalesce(F.sum("rn").over(before), F.lit(0)).alias("rn0"), F.coalesce(F.sum("rb").over(before), F.lit(0)).alias("rb0"))
    inside = W.partitionBy("range").orderBy("h", "part").rowsBetween(W.unboundedPreceding, -1)
    group = W.partitionBy("range", "h")
    runs = runs.select(
        "range", "h", "part", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("pn"),
        F.coalesce(F.sum("b").over(inside), F.lit(0)).alias("pb"), F.sum("b").over(group).alias("g_bytes"),
    )
    runs = runs.withColumn("gb", F.min("pb").over(group)).join(F.broadcast(totals), "range")
    runs = runs.select("range", "h", "part", (F.col("rn0") + F.col("pn")).alias("n0"), (F.col("rb0") + F.col("pb")).alias("b0"), (F.col("rb0") + F.col("gb")).alias("g_before"), "g_bytes")
    run = W.partitionBy("range", "h", "part").orderBy("d", "size", "crc")
    local = placed.select(
        "*", (F.row_number().over(run) - 1).alias("i"),
        F.coalesce(F.sum("size").over(run.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("ib"),
    )
    out = local.join(runs, ["range", "h", "part"])
    return out.withColumn("n_before", F.col("n0") + F.col("i")).withColumn("b_before", F.col("b0") + F.col("ib"))


def shard(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", whole_share: float = WHOLE_SHARE, ranges: int = RANGES, sample: int = SAMPLE) -> DataFrame:
    """(doc, size, text_crc32, shard, slot) for every record; slots run from 0 without gaps in each shard."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    integral = docs.schema[doc_id].dataType.typeName() in ("byte", "short", "integer", "long")
    d = F.col(doc_id).cast("bigint") if integral else F.xxhash64(F.col(doc_id))
    records = work_table(
        docs.select(F.col(doc_id).alias("doc"), F.coalesce(d, F.lit(-(1 << 63))).alias("d"), F.xxhash64(F.col(text)).alias("h"), (F.octet_length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("crc")),
        "shard-records",
    )
    total = records.agg(F.sum("size")).first()[0] or 1
    line = ordered(records, ranges, sample)
    whole = F.col("g_bytes") <= F.lit(whole_share * total / shards)
    # The middle of the record, or of its group, decides: cut errors fall evenly on both sides.
    middle = F.when(whole, F.col("g_before") + F.col("g_bytes") / 2).otherwise(F.col("b_before") + F.col("size") / 2)
    cut = line.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(total))).cast("int"))
    cut = work_table(cut.select("doc", "size", "crc", "shard", "n_before"), "shard-cut")
    # Key order and shard order agree, so a shard's records are one stretch of the line.
    first = cut.groupBy("shard").agg(F.min("n_before").alias("n_first"))
    return cut.join(F.broadcast(first), "shard").select(
        "doc", "size", F.col("crc").alias("text_crc32"), "shard", (F.col("n_before") - F.col("n_first")).cast("bigint").alias("slot"),
    )


def op6_query(docs: DataFrame) -> DataFrame:
    """The contract's columns under the law of equal bytes."""
    return shard(docs).select(
        F.col("doc").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
