"""Mixing sources to target weights by subset-sum budget fitting.

Sources share the whole token budget by weight; a target above ``cap`` times its source's size stops there and the
excess is reshared.  A source takes every document ``floor(target / size)`` times and then fits the rest exactly:
documents are counted by exact token length, a proportional share of every length is taken, and a
bounded-knapsack dynamic program over the lengths left spends the remaining budget.  Which documents of a length
are taken is decided by a seeded hash.

Documents never meet: tasks see counts by (source, length).  The program's table is a bit set of at most
``WINDOW`` budgets, whatever the source's size.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, last in order; null
ids are documents like any other; among equal rows it does not matter which is taken; sources of
size 0 have target 0; an empty table gives no rows.  Reruns agree.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.config import work_table
from trailmark.llm.common import SPACE

# Fixed values of the query's contract.
WEIGHTS = (5, 2, 1)
CAP = 3

WINDOW = 1 << 15
SEED = 20240
HASH_PARTS = 256
BROADCAST_SOURCES = 100_000  # beyond this many sources the plan is joined by shuffle


def token_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")).cast("bigint")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> dict[str | None, float]:
    """Target tokens per source.  ``sizes`` in order; the weights repeat along it."""
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(sizes)}
    size = dict(sizes)
    out: dict[str | None, float] = {}
    left, open_ = float(sum(size.values())), list(size)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > cap * size[s]]
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        for s in full:
            out[s] = float(cap * size[s])
            left -= out[s]
            open_.remove(s)
    return out


def fit_budget(lengths: list[int], counts: list[int], budget: int, window: int = WINDOW) -> list[int]:
    """How many documents of each length to take so that lengths sum to ``budget``, or as near below as can be.

    Of what lies beyond half a ``window`` a proportional share of every length comes first.  What is left is brought under
    the window by taking long documents, and spent by a bounded knapsack over the counts left (binary-split, one big
    integer as bit set).  A budget within half a window is fitted by the knapsack alone, as well as can be.
    """
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if budget >= total:
        return list(counts)
    taken = [c * max(0, budget - window // 2) // total for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, taken, strict=True))
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if left <= window // 2:
            break
        more = min(counts[i] - taken[i], (left - window // 2) // lengths[i] + 1, left // lengths[i])
        taken[i] += more
        left -= more * lengths[i]
    # Reachable sums so far; layers[i] is the set before item i was offered.
    room = (1 << (left + 1)) - 1
    reach, layers, items = 1, [], []
    for i, n in enumerate(lengths):
        spare, chunk = min(counts[i] - taken[i], left // n), 1
        while spare > 0:
            part = min(chunk, spare)
            layers.append(reach)
            items.append((i, part))
            reach = (reach | reach << (n * part)) & room
            spare -= part
            chunk *= 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for (i, part), before in zip(reversed(items), reversed(layers), strict=True):
        if not before >> at & 1:
            taken[i] += part
            at -= part * lengths[i]
    return taken


def _fit_source(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size")
    size = int((group["size"] * group["docs"]).sum())
    target = float(group["target"].iloc[0])
    repeats, rest = divmod(round(target), size) if size else (0, 0)
    take = fit_budget(group["size"].tolist(), group["docs"].tolist(), int(rest)) if size else [0] * len(group)
    return pd.DataFrame({"k": group["k"], "size": group["size"], "repeats": repeats, "take": take})


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, seed: int = SEED,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """(doc, h, k, size, source_size, target, times) per document; ``h`` is a hash of id and text, ``k`` the source's number.

    ``times`` is how often the mix takes the document.  One row per source reaches the driver.
    """
    spark = docs.sparkSession
    narrow = work_table(
        docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("h"), F.col(source).alias("source"), token_count(F.col(text)).alias("size")),
        "mix-sizes",
    )
    by_length = work_table(narrow.groupBy("source", "size").agg(F.count("*").alias("docs")), "mix-lengths")
    found = by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size")).collect()
    # Python orders strings by code point.
    order = sorted(((r["source"], r["source_size"]) for r in found), key=lambda r: (r[0] is None, r[0] or ""))
    goal = targets(order, weights, cap)
    rows = [(s, k, n, goal[s]) for k, (s, n) in enumerate(order)]
    plan = spark.createDataFrame(rows, "source string, k int, source_size bigint, target double")
    if len(rows) <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    same = narrow["source"].eqNullSafe(plan["source"])
    counted = by_length.filter("size > 0").join(plan, by_length["source"].eqNullSafe(plan["source"])).select("k", "size", "docs", "target")
    fitted = counted.groupBy("k").applyInPandas(_fit_source, "k int, size bigint, repeats bigint, take bigint")
    fitted = work_table(fitted, "mix-fit")
    named = narrow.join(plan, same).select("doc", "h", "k", "size", "source_size", "target")
    # The first `take` documents of (source, length) by hash.  A hash part that lies wholly inside or outside is decided by
    # its count; only the part on the edge is ordered, so a length shared by a third of all rows needs no big sort.
    part = F.pmod(F.col("h"), F.lit(HASH_PARTS))
    parts = named.groupBy("k", "size", part.alias("part")).agg(F.count("*").alias("n"))
    before = W.partitionBy("k", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(fitted, ["k", "size"], "left")
    parts = parts.select("k", "size", "part", "before", F.coalesce("repeats", F.lit(0)).alias("repeats"), F.coalesce("take", F.lit(0)).alias("take"))
    ranked = named.withColumn("part", part.cast("bigint")).withColumn("i", F.row_number().over(W.partitionBy("k", "size", "part").orderBy("h", "doc")))
    out = ranked.join(parts.withColumn("part", F.col("part").cast("bigint")), ["k", "size", "part"])
    times = F.col("repeats") + (F.col("before") + F.col("i") <= F.col("take")).cast("bigint")
    return out.select("doc", "h", "k", "size", "source_size", "target", F.when(F.col("size") > 0, times).otherwise(F.lit(0)).alias("times"))


def mixed_documents(docs: DataFrame, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` as the mix takes them: rows repeated or left out, columns unchanged.

    Rows with equal id and text share a key; their takes are summed and dealt out evenly among them.
    """
    taken = mix(docs, seed=seed, doc_id=doc_id, text=text, **options)
    key = F.struct(F.col("doc").alias("id"), F.col("h"))
    per_key = taken.groupBy(key.alias("key")).agg(F.sum("times").alias("total"), F.count("*").alias("n")).filter("total > 0")
    own = F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("h"))
    some = docs.select(F.struct("*").alias("row"), own.alias("key")).join(per_key, "key")
    some = some.withColumn("i", F.row_number().over(W.partitionBy("key").orderBy("n")))
    times = F.floor(F.col("total") / F.col("n")) + (F.col("i") <= F.col("total") % F.col("n")).cast("bigint")
    return some.withColumn("times", times).filter("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).select("row.*")


def op9_query(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    return mix(docs).select(F.col("doc").alias("doc_id"), "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))
