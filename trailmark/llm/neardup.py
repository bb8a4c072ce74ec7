"""Near-duplicate detection with ProbMinHash.

A text is a weighted set of shingles of ``SHINGLE`` words; a shingle seen f times weighs 1 + ln f.  Every shingle is a Poisson
process whose rate is its weight: its arrivals hit random registers, each register keeps the earliest arrival, and a
shingle stops as soon as its next arrival lies beyond all registers of the text (early termination).  Two registers are equal
with the probability Jaccard similarity of the texts.  Bands of registers propose candidates, and candidates are verified by the
exact Jaccard similarity of their shingle sets, at least ``SIMILARITY``.  A second signature with weight 1 for every
shingle, whose registers are equal with just that similarity, proposes texts that differ in how often shingles repeat;
it is the first one again where nothing repeats.

Texts with equal word sequences are one node.  In each of ``PIVOT_ROUNDS`` rounds the nodes of a bucket are compared with one
pivot instead of with each other, and verified links give nodes common labels.  What is left, pairs of a bucket with
different labels, is then verified and linked inside the tasks that hold the bucket's blocks, so that only a spanning set
of links leaves them.  So no proposed link between classes is lost, though links inside a class need never be spelled
out.  What spares pairs the verification is an upper bound of their similarity: shingles
are tallied in ``CELLS`` cells, and two texts share at most the lesser count of every cell.

The bands follow from the threshold: a pair just at it is proposed by no band with a chance of at most ``MISS``, about 3 in
a million, which falls steeply above it.  For 0.8 these are 24 bands of 4 registers.

Defined cases: a text of fewer than five words, but not none, has one shingle of all its words; texts without words are alike only
if they are equal (null counts as empty); null ids are documents like any other; repeated rows are copies; an empty
table gives no rows.  Columns other than id and text are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.config import work_table
from trailmark.llm.common import row_key, slices, text_bytes
from trailmark.llm.imatch import scramble, term_hashes

SHINGLE = 5
SIMILARITY = 0.8
MISS = 3.3e-6
ROWS = 4  # registers of a band, fewer where that takes over MOST_BANDS bands
MOST_BANDS = 64
CELLS = 128
PIVOT_ROUNDS = 3
BLOCK = 1000
BLOCK_ITEMS = 4_000_000  # shingles of a block
BROADCAST_ROWS = 1_000_000  # of two or three numbers each

_PLACES = scramble(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def banding(similarity: float) -> tuple[int, int]:
    """(bands, registers of a band) that lose a pair at ``similarity`` with chance ``MISS`` at most."""
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    for rows in range(ROWS, 0, -1):
        hit = similarity**rows
        bands = math.ceil(math.log(MISS) / math.log1p(-hit)) if hit < 1 else 1
        if bands <= MOST_BANDS:
            break
    return bands, rows


def shingles(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle) with their counts, sorted; and a hash of each row's word sequence."""
    rows = len(at) - 1
    row, word = term_hashes(raw, at)
    n = np.bincount(row, minlength=rows)
    begin = np.concatenate(([0], np.cumsum(n)))[:-1]
    place = np.arange(len(row)) - begin[row]
    # Word sequence: places make the sum depend on order.
    ordered = scramble(word + scramble(place.astype(np.uint64) * np.uint64(2) + np.uint64(1)))
    whole = np.zeros(rows, np.uint64)
    np.add.at(whole, row, ordered)
    whole = scramble(whole ^ n.astype(np.uint64))
    for r in np.flatnonzero(n == 0).tolist():  # no words: the characters decide
        spot = np.arange(at[r + 1] - at[r], dtype=np.uint64)
        whole[r] = scramble(np.sum(scramble(raw[at[r]:at[r + 1]].astype(np.uint64) + (spot << np.uint64(9)) + np.uint64(257)), keepdims=True, dtype=np.uint64))[0]
    # A shingle begins at every word that has four more behind it, and at the first word of a shorter text.
    starts = np.flatnonzero((place + SHINGLE <= n[row]) | ((place == 0) & (n[row] < SHINGLE)))
    total = np.zeros(len(starts), np.uint64)
    for j in range(SHINGLE):
        there = starts + j
        inside = there < (begin + n)[row[starts]]
        total += np.where(inside, word[np.minimum(there, len(word) - 1)] * _PLACES[j] if len(word) else 0, np.uint64(0))
    value, at_row = scramble(total), row[starts]
    order = np.lexsort((value, at_row))
    value, at_row = value[order], at_row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (at_row[1:] != at_row[:-1])
    first = np.flatnonzero(new)
    return at_row[first], value[first], np.diff(np.append(first, len(value))), whole


def signatures(row: np.ndarray, item: np.ndarray, weight: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """(rows, registers) of winning items; a row without items has zeros."""
    earliest = np.full(rows * registers, np.inf)
    winner = np.zeros(rows * registers, np.uint64)
    time, seed = np.zeros(len(item)), scramble(item ^ np.uint64(0xD1B54A32D192ED03))
    row, rate, step = row.copy(), weight.copy(), 0
    while len(item):
        step += 1
        draw = scramble(seed + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        # High bits give the waiting time, low bits the register.
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / rate
        spot = row * registers + (scramble(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, spot, time)
        won = earliest[spot] == time
        winner[spot[won]] = item[won]
        latest = earliest.reshape(rows, registers).max(axis=1)
        on = time < latest[row]
        row, item, rate, time, seed = row[on], item[on], rate[on], time[on], seed[on]
    return winner.reshape(rows, registers)


def _bands(row: np.ndarray, item: np.ndarray, weight: np.ndarray, rows: int, bands: int, deep: int) -> np.ndarray:
    """(rows, bands): hashes of each band's registers."""
    sig = signatures(row, item, weight, rows, bands * deep).reshape(rows, bands, deep)
    band = np.zeros((rows, bands), np.uint64)
    for j in range(deep):
        band = scramble(band + sig[:, :, j] * _PLACES[j])
    return scramble(band + np.arange(bands, dtype=np.uint64))


def _sign(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    bands, deep = banding(similarity)
    for whole_batch in batches:
        for batch in slices(whole_batch, "text"):
            raw, at = text_bytes(batch.column("text"))
            row, item, count, whole = shingles(raw, at)
            rows = batch.num_rows
            some = np.bincount(row, minlength=rows) > 0
            repeats = np.bincount(row[count > 1], minlength=rows) > 0
            band = np.concatenate([_bands(row, item, np.ones(len(item)), rows, bands, deep), np.zeros((rows, bands), np.uint64)], axis=1)
            # Where no shingle repeats, the weighted signature is the same.
            again = repeats[row]
            number = np.cumsum(repeats) - 1
            band[repeats, bands:] = _bands(number[row[again]], item[again], 1 + np.log(count[again]), int(repeats.sum()), bands, deep)
            there = np.repeat(np.stack([some, repeats], axis=1), bands, axis=1)
            each = np.concatenate(([0], np.cumsum(there.sum(axis=1)))).astype(np.int32)
            small = (item >> np.uint64(32)).astype(np.uint32)
            new = np.ones(len(small), bool)
            new[1:] = (small[1:] != small[:-1]) | (row[1:] != row[:-1])
            row, small = row[new], small[new]
            sets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows)))).astype(np.int32)
            tally = np.bincount(row * CELLS + small % CELLS, minlength=rows * CELLS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), batch.column("h"), pa.array(whole.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(each), pa.array(band[there].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * CELLS), pa.array(tally)),
                    pa.ListArray.from_arrays(pa.array(sets), pa.array(small.view(np.int32))),
                ],
                names=["doc", "h", "node", "bands", "tally", "items"],
            )


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node in ``edges`` (a, b): the least node it is linked to over any number of links.

    Each round takes the least of the neighbours' labels and of the own label's label (pointer jumping).
    """
    both = work_table(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-links")
    labels = work_table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "near-labels")
    total = F.sum(F.col("comp").cast("decimal(38,0)"))
    before = labels.agg(total).first()[0]
    while True:
        near = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "comp")
        jump = labels.select(F.col("node").alias("to"), F.col("comp").alias("further"))
        own = labels.join(jump, F.col("comp") == F.col("to")).select("node", F.col("further").alias("comp"))
        labels = work_table(near.union(own).groupBy("node").agg(F.min("comp").alias("comp")), "near-labels")
        # Labels only ever fall, so an unchanged sum means that none did.
        after = labels.agg(total).first()[0]
        if after == before:
            return labels
        before = after


def _small(df: DataFrame) -> DataFrame:
    """A written table of narrow rows, broadcast while it has at most ``BROADCAST_ROWS`` of them."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _both_sides(pairs: DataFrame, signed: DataFrame, column: str) -> DataFrame:
    """``pairs`` (a, b) with ``sides``, the column's values of both nodes.

    The narrow pairs go to the wide rows, and each wide row travels once per pair.
    """
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node"))
    found = signed.select("node", column).join(_small(work_table(ends, "near-ends")), "node")
    return found.groupBy("a", "b").agg(F.collect_list(column).alias("sides"))


def _alike(pairs: DataFrame, signed: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` whose tallies do not rule them out."""
    one, other = F.col("sides").getItem(0), F.col("sides").getItem(1)
    most = F.aggregate(F.zip_with(one, other, lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    total = lambda side: F.aggregate(side, F.lit(0), lambda s, x: s + x)
    both = _both_sides(pairs, signed, "tally").select("a", "b", most.alias("most"), (total(one) + total(other)).alias("total"))
    return both.filter(F.col("most") >= F.lit(similarity) * (F.col("total") - F.col("most"))).select("a", "b")


def verify(pairs: DataFrame, signed: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose shingle sets are similar enough."""
    one, other = F.col("sides").getItem(0), F.col("sides").getItem(1)
    common = F.size(F.array_intersect(one, other))
    full = _both_sides(pairs, signed, "items")
    return full.filter(common >= F.lit(similarity) * (F.size(one) + F.size(other) - common)).select("a", "b")


def _links_in_block(group: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Verified links between different labels of a bucket's block, fewer than there are labels.

    Every pair is either under one label by then, ruled out by its tallies, or verified.
    """
    tally = np.stack(group["tally"].to_numpy()).astype(np.int32)
    node, side = group["node"].to_numpy(), group["block"].to_numpy()
    within = group["low"].iloc[0] == group["high"].iloc[0]
    label = np.unique(group["label"].to_numpy(), return_inverse=True)[1]
    size = group["items"].map(len).to_numpy()
    distinct, item = np.unique(np.concatenate(group["items"].to_numpy()), return_inverse=True)
    begin = np.cumsum(size) - size
    own, a, b = np.zeros(len(distinct), bool), [], []
    for i in range(len(node) - 1):
        rest = slice(i + 1, None)
        some = np.flatnonzero((label[rest] != label[i]) & (within | (side[rest] != side[i]))) + i + 1
        if not len(some):
            continue
        most = np.minimum(tally[some], tally[i]).sum(axis=1)
        some = some[most >= similarity * (size[some] + size[i] - most)]
        if not len(some):
            continue
        mine = item[begin[i]:begin[i] + size[i]]
        own[mine] = True
        n = size[some]
        first = np.cumsum(n) - n
        common = np.add.reduceat(own[item[np.arange(n.sum()) + np.repeat(begin[some] - first, n)]].astype(np.int64), first)
        own[mine] = False
        for j in some[common >= similarity * (n + size[i] - common)].tolist():
            if label[j] != label[i]:
                a.append(min(node[i], node[j]))
                b.append(max(node[i], node[j]))
                label[label == label[j]] = label[i]
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def links_left(held: DataFrame, signed: DataFrame, similarity: float) -> DataFrame:
    """Verified links (a, b) that join what pairs of a bucket with different labels join.

    ``held`` has (bucket, node, label).  A bucket of more than ``BLOCK`` nodes or ``BLOCK_ITEMS`` shingles is cut into blocks.
    Nodes of its most frequent label need not meet each other, so they have blocks of their own (the last ones), and
    every other block meets itself and all blocks in a task each; no task holds more than two blocks.
    """
    kinds = held.join(_small(work_table(signed.select("node", F.size("items").alias("size")), "near-sizes")), "node")
    kinds = kinds.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    n, size = F.col("n"), F.col("size")
    sizes = kinds.groupBy("bucket").agg(F.max(F.struct("n", "label", "size")).alias("main"), F.count("*").alias("labels"), F.sum("n").alias("n"), F.sum("size").alias("size"))
    # The two nodes of a bucket have met in the first pivot round.
    sizes = sizes.filter((F.col("labels") > 1) & (n > F.lit(2 if PIVOT_ROUNDS else 1)))
    cut = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_ITEMS)).cast("int")
    whole = cut(n, size) <= 1
    odd = F.when(whole, 1).otherwise(cut(n - F.col("main.n"), size - F.col("main.size")))
    main = F.when(whole, 0).otherwise(cut(F.col("main.n"), F.col("main.size")))
    sizes = sizes.select("bucket", F.col("main.label").alias("main_label"), odd.alias("odd"), main.alias("main"))
    mains = (F.col("label") == F.col("main_label")) & (F.col("main") > 0)
    part = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
    rows = held.join(sizes, "bucket").withColumn("block", F.when(mains, F.col("odd") + part("main")).otherwise(part("odd")))
    other = F.explode(F.sequence(F.lit(0), F.when(mains, F.col("odd")).otherwise(F.col("odd") + F.col("main")) - 1)).alias("other")
    rows = rows.select("bucket", "node", "label", "block", other)
    rows = rows.select("bucket", "node", "label", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    rows = rows.join(signed, "node")
    found = rows.groupBy("bucket", "low", "high").applyInPandas(lambda group: _links_in_block(group, similarity), "a bigint, b bigint")
    return found.distinct()


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(doc, h, node, comp): every row with its class; ``h`` is a hash of the text."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc {kind}, h bigint, node bigint, bands array<bigint>, tally array<int>, items array<int>"
    signed_rows = work_table(rows.mapInArrow(lambda it: _sign(it, similarity), schema), "near-signed")
    members = signed_rows.select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high")
    members = work_table(members.join(shared.select("bucket"), "bucket", "left_semi").distinct(), "near-members")
    # Of the wide columns only those of candidates move.  Copies have equal signatures, so any of a node's rows will do.
    nodes = work_table(members.select("node").distinct(), "near-candidates")
    signed = signed_rows.select("node", "tally", "items").join(_small(nodes), "node", "left_semi")
    signed = work_table(signed.groupBy("node").agg(F.first("tally").alias("tally"), F.first("items").alias("items")), "near-nodes")
    labels, links = nodes.select("node", F.col("node").alias("label")), []
    for turn in range(PIVOT_ROUNDS):
        held = members.join(labels, "node")
        # First one order for all buckets, so that a class meets few pivots; then one of each bucket's own, so that what
        # the first pivots did not link meets many.
        order = F.xxhash64(F.lit(turn), "node") if turn == 0 else F.xxhash64(F.lit(turn), "bucket", "node")
        pivot = held.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "node", "label")).alias("p"))
        met = held.join(pivot, "bucket").filter(F.col("label") != F.col("p.label"))
        pairs = met.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()
        found = work_table(verify(_alike(work_table(pairs, "near-pairs"), signed, similarity), signed, similarity), "near-verified")
        links.append(found)
        end = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))  # noqa: B023
        met = found.join(end("a"), "a").join(end("b"), "b").select(F.explode(F.array("label_a", "label_b")).alias("label"), F.least("label_a", "label_b").alias("to"))
        lower = met.groupBy("label").agg(F.min("to").alias("to"))
        labels = work_table(labels.join(lower, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "near-labels")
    links.append(work_table(links_left(members.join(labels, "node"), signed, similarity), "near-left"))
    comp = components(reduce(DataFrame.union, links))
    return signed_rows.select("doc", "h", "node").join(comp, "node", "left").select("doc", "h", "node", F.coalesce("comp", "node").alias("comp"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(id, class_id, class_size) per row: the least id of its class and the number of rows in it."""
    found = work_table(near_classes(docs, doc_id, text, similarity), "near-classes")
    classes = found.groupBy("comp").agg(F.min("doc").alias("class_id"), F.count("*").alias("class_size")).filter("class_size > 1")
    own = found.join(_small(work_table(classes, "near-sizes")), "comp", "left")
    return own.select(F.col("doc").alias(doc_id), F.when(F.col("class_size").isNull(), F.col("doc")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of every class: the least by (id, text hash); of repeated rows any one."""
    found = work_table(near_classes(docs, doc_id, text, similarity).select("doc", "h", "comp"), "near-classes")
    key = F.struct(F.col("doc").alias("id"), "h")
    classes = found.groupBy("comp").agg(F.min(key).alias("keep"), F.count("*").alias("n")).filter("n > 1")
    # Only narrow keys move: of what goes, and of what stays and stands there more than once.
    in_class = found.join(_small(work_table(classes.select("comp", "keep"), "near-kept")), "comp").select(key.alias("key"), "keep")
    keys = work_table(in_class.groupBy("key", F.col("key").eqNullSafe(F.col("keep")).alias("kept")).agg(F.count("*").alias("n")), "near-keys")
    gone, again = keys.filter("not kept or n > 1").select("key"), keys.filter("kept and n > 1").select("key")
    rows = docs.select(F.struct("*").alias("row"), row_key(F.col(doc_id), F.col(text)).alias("key"))
    left = rows.join(_small(gone), "key", "left_anti").select("row.*")
    one = rows.join(_small(again), "key", "left_semi").groupBy("key").agg(F.first("row").alias("row")).select("row.*")
    return left.unionByName(one)


def op8_query(docs: DataFrame) -> DataFrame:
    """One row per document: its class, named by the least id in it, and the number of rows of the class."""
    return near_duplicates(docs)
