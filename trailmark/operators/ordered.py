"""Per-key ordered computations that hold when one key owns much of the data.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in one task.  Here each key is cut
into time buckets: rows are ordered inside (key, bucket), one summary row per (key, bucket) is
ordered across buckets, and the two are combined.  A key then costs one task at most the number
of buckets in its time span, while its rows spread over many tasks.  The results equal the plain
window's.

The input is read twice (rows and summaries); pass a table scan or ``work_table`` output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

HOUR = 3600
DAY = 86400

_NULL_KEY = "\x00null"
_BUCKET = "_bucket"

OverRows = Callable[[WindowSpec], Column]


def time_bucket(col: Column, width: int) -> Column:
    """Number of the ``width``-second bucket since the epoch."""
    return F.floor(F.unix_seconds(col) / F.lit(width)).cast("long")


def two_level(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    order: Sequence[Column],
    within: dict[str, OverRows],
    summary: dict[str, Column],
    across: dict[str, OverRows],
    width: int = HOUR,
    descending: bool = False,
) -> DataFrame:
    """Add ``within`` columns (ordered inside a bucket) and ``across`` columns (ordered over the
    key's bucket summaries).  The caller combines them and drops what it does not need.

    Key columns may be NULL; NULLs form one group, as in a window.
    """
    parts = [f"_k{i}" for i in range(len(keys))]
    safe = {p: F.coalesce(F.col(k).cast("string"), F.lit(_NULL_KEY)) for p, k in zip(parts, keys)}
    rows = df.withColumns({**safe, _BUCKET: time_bucket(F.col(time), width)})
    group = [*parts, _BUCKET]

    totals = rows.groupBy(*group).agg(*[c.alias(n) for n, c in summary.items()])
    bucket_order = F.col(_BUCKET).desc() if descending else F.col(_BUCKET).asc()
    over_buckets = Window.partitionBy(*parts).orderBy(bucket_order)
    carried = totals.select(*group, *[f(over_buckets).alias(n) for n, f in across.items()])

    over_rows = Window.partitionBy(*group).orderBy(*order)
    local = rows.withColumns({n: f(over_rows) for n, f in within.items()})
    # A NULL time has a NULL bucket; it keeps its rows through the outer join.
    return local.join(carried, group, "left").drop(*group)


def with_order(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str] = (),
    position: str | None = None,
    size: str | None = None,
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    width: int = HOUR,
) -> DataFrame:
    """Any of these by time within ``keys``, in one pass: ``row_number()``, the group's row count,
    and ``lag`` / ``lead`` of columns (output name to column)."""
    within: dict[str, OverRows] = {}
    summary: dict[str, Column] = {}
    across: dict[str, OverRows] = {}
    final: dict[str, Column] = {}
    place = F.struct(F.col(time), *map(F.col, ties))
    if position or size:
        summary["_n"] = F.count(F.lit(1))
    if position:
        within["_rn"] = lambda w: F.row_number().over(w)
        across["_before"] = lambda w: F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1))
        final[position] = (F.col("_rn") + F.coalesce("_before", F.lit(0))).cast("long")
    if size:
        across["_size"] = lambda w: F.sum("_n").over(
            w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        final[size] = F.col("_size")
    for tag, wanted, step, edge in (("p", previous, F.lag, F.max_by), ("f", following, F.lead, F.min_by)):
        for i, (out, column) in enumerate((wanted or {}).items()):
            near, far, last = f"_near_{tag}{i}", f"_far_{tag}{i}", f"_edge_{tag}{i}"
            # The struct tells a NULL value from "no such row".
            cell = F.struct(F.col(column).alias("v"))
            within[near] = lambda w, step=step, cell=cell: step(cell).over(w)
            summary[last] = edge(cell, place)
            across[far] = lambda w, step=step, last=last: step(F.col(last)).over(w)
            final[out] = F.coalesce(near, far)["v"]
    joined = two_level(df, keys, time, [F.col(time), *map(F.col, ties)], within, summary, across, width)
    return joined.withColumns(final).drop(*within, *across)


def with_following_match(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[Column],
    candidate: Column, candidate_order: Column, out: str, width: int = HOUR,
) -> DataFrame:
    """Nearest later row whose ``candidate`` is not NULL.

    ``order`` lists the row order from last to first, so the frame only ever looks back and the
    pass stays linear.  ``candidate_order`` picks a bucket's earliest candidate.
    """
    behind = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    joined = two_level(
        df.withColumn("_cand", candidate), keys, time, order,
        within={"_near": lambda w: F.last("_cand", ignorenulls=True).over(behind(w))},
        summary={"_edge": F.min_by("_cand", F.when(F.col("_cand").isNotNull(), candidate_order))},
        across={"_far": lambda w: F.last("_edge", ignorenulls=True).over(behind(w))},
        width=width, descending=True,
    )
    return joined.withColumn(out, F.coalesce("_near", "_far")).drop("_near", "_far", "_cand")


def sessionize(
    df: DataFrame, keys: Sequence[str], time: str, gap_seconds: int, out: str
) -> DataFrame:
    """Number sessions per key: a new one starts after more than ``gap_seconds`` without a row.

    With buckets as wide as the gap no break can fall inside a bucket, so breaks are found on the
    bucket summaries alone and rows are never sorted.  Keys must not be NULL.
    """
    rows = df.withColumn(_BUCKET, time_bucket(F.col(time), gap_seconds))
    group = [*keys, _BUCKET]
    spans = rows.groupBy(*group).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    w = Window.partitionBy(*keys).orderBy(_BUCKET)
    idle = F.col("_first") > F.col("_prev") + F.make_dt_interval(secs=F.lit(gap_seconds))
    numbered = (
        spans.withColumn("_prev", F.lag("_last").over(w))
        .withColumn("_new", F.when(F.col("_prev").isNull() | idle, 1).otherwise(0))
        .withColumn(out, F.sum("_new").over(w).cast("long"))
        .select(*group, out)
    )
    return rows.join(numbered, group).drop(_BUCKET)
