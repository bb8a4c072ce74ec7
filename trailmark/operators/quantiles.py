"""Exact percentiles of groups of any size, by rank selection.

``percentile()`` keeps a map of all distinct values of a group and merges it in one task.  Here a group's values are cut at
approximate quantiles into ranges; counting rows by range tells which range holds a wanted rank, and only that range is
looked at again, cut once more or, at the last level, ordered.  A cut value is a range of its own, so a value that fills
a third of the rows is found by counting.  No task holds more than one last range of a group, about
``ranges ** -levels`` of its rows, and of these the distinct values.

The approximate quantiles depend on the order in which sketches are merged, so every evaluation may cut elsewhere.  Cuts are
therefore written once a level, and all that counts or looks up by them reads the same ones.  The rest stays a plan.
The input is read once for the cuts and twice a level.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.config import work_table

RANGES, LEVELS = 32, 2


def _cuts(ranges: int) -> Column:
    """Values of the group that part it into about equal ranges; a sketch of fixed size that merges map-side."""
    at = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    return F.array_distinct(F.percentile_approx("v", at, 8 * ranges))


def _at_ranks(rows: DataFrame, cuts: DataFrame | None, targets: DataFrame, ranges: int, levels: int) -> DataFrame:
    """(k, rank, v): the value at each target rank, from 0, of (k, v) rows; ``cuts`` has (k, cuts) as written, none at the last level."""
    if not levels:
        counted = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"))
        upto = F.sum("c").over(Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        placed = counted.withColumn("upto", upto).join(targets, "k")
        return placed.filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("c"))).select("k", "rank", "v")
    # Even codes are the open ranges between cuts, odd ones the cuts themselves.
    below = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    code = (2 * below + F.array_contains("cuts", F.col("v")).cast("int")).alias("code")
    coded = rows.join(cuts, "k").select("k", "v", code)
    counted = coded.groupBy("k", "code").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("k").orderBy("code").rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("upto") - F.col("c")
    held = counted.withColumn("upto", upto).join(targets, "k").filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= before))
    held = held.select("k", "rank", "code", (F.col("rank") - before).alias("inner"))
    is_cut = F.col("code") % 2 == 1
    points = held.filter(is_cut).join(cuts, "k").select("k", "rank", F.col("cuts")[F.floor(F.col("code") / 2).cast("int")].alias("v"))
    within = F.struct("k", "code").alias("k")
    opened = held.filter(~is_cut).select("k", "rank", within.alias("deep"), "inner")
    wanted = opened.select(F.col("deep").alias("k"), F.col("inner").alias("rank")).distinct()
    inside = coded.select(within, "v").join(wanted.select("k"), "k", "left_semi")
    inner_cuts = work_table(inside.groupBy("k").agg(_cuts(ranges).alias("cuts")), "cuts") if levels > 1 else None
    deeper = _at_ranks(inside, inner_cuts, wanted, ranges, levels - 1)
    deeper = deeper.select(F.col("k").alias("deep"), F.col("rank").alias("inner"), "v")
    return points.unionByName(opened.join(deeper, ["deep", "inner"]).select("k", "rank", "v"))


def exact_percentiles(
    rows: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, float], ranges: int = RANGES, levels: int = LEVELS,
) -> DataFrame:
    """Percentiles of ``value`` by ``keys``, one column each (name to fraction), interpolated between neighbours like ``percentile``.

    NULLs do not count; a group without values has NULL.  Key columns may be NULL.  Without keys there is one row.
    """
    key = F.struct(*keys) if keys else F.lit(0)
    narrow = rows.select(key.alias("k"), F.col(value).cast("double").alias("v"))
    sizes = work_table(narrow.groupBy("k").agg(F.count("v").alias("n"), _cuts(ranges).alias("cuts")), "cuts")
    place = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    ends = [end(place(p)).cast("long") for p in wanted.values() for end in (F.floor, F.ceil)]
    some = sizes.filter("n > 0")
    targets = some.select("k", F.explode(F.array_distinct(F.array(*ends))).alias("rank"))
    found = _at_ranks(narrow.filter("v is not null"), some.select("k", "cuts"), targets, ranges, levels)
    # Of ranks at most two a percentile, so a group's row is small.
    values = found.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))
    joined = sizes.select("k", "n").join(values, "k", "left")
    out = []
    for name, p in wanted.items():
        low, high = F.floor(place(p)).cast("long"), F.ceil(place(p)).cast("long")
        at = lambda rank: F.try_element_at("at", rank)
        between = (high - place(p)) * at(low) + (place(p) - low) * at(high)
        out.append(F.when(low == high, at(low)).otherwise(between).alias(name))
    if not keys:
        return joined.select(*out).agg(*[F.max(name).alias(name) for name in wanted])
    return joined.select(*[F.col("k")[c].alias(c) for c in keys], *out)
