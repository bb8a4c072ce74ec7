"""Document fingerprints by I-Match over randomised lexicons.

Document frequencies of all terms are counted over all distinct texts.  The lexicon keeps terms whose inverse document
frequency lies in a band: no term in more than ``max_share`` and none in fewer than ``min_share`` of the texts.
A document keeps its distinct lexicon terms, or all its distinct terms where none is in the lexicon; each of ``SUBSETS`` randomised lexicon subsets hashes
the sorted distinct terms of the document that fall into it.  Two documents are alike to the share of equal subset hashes
among the subsets in which either has terms.

How much of the lexicon a subset keeps depends on the document: at level L a subset keeps each term with chance
4^-L, and a document uses the level that leaves it about half a term to two terms a subset, and the next one, so that an
edit changes some of the hashes and not all, for short and long texts alike.

The lexicon has at most (mean distinct terms per document) / min_share entries, whatever the corpus size, since every entry
accounts for min_share of the documents; it is collected as 64-bit hashes and broadcast.

Defined cases: a null text counts as empty; a text without terms is fingerprinted by a hash of its characters,
like only to itself; equal texts have equal fingerprints; ids sort nulls first and ties by text; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.config import work_table
from trailmark.llm.common import slices, text_bytes

MIN_SHARE = 0.0005
MAX_SHARE = 0.25
SUBSETS = 32
WHOLE = 1 << 32  # what a text counts; its copies share it
BROADCAST_ROWS = 1_000_000  # of two numbers each
MAX_LEVEL = 8
SEED = np.uint64(0x9E3779B97F4A7C15)

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def _lower_and_kind() -> tuple[np.ndarray, np.ndarray]:
    """For each byte: its lower-case form, and whether it belongs to a term (letters, digits, all beyond ASCII)."""
    b = np.arange(256, dtype=np.uint8)
    upper = (b >= 65) & (b <= 90)
    lower = np.where(upper, b + 32, b).astype(np.uint8)
    term = ((lower >= 97) & (lower <= 122)) | ((b >= 48) & (b <= 57)) | (b >= 128)
    return lower, term


_LOWER, _TERM = _lower_and_kind()
# Powers of the hash base by place in the term; longer terms wrap around the table.
_POWERS = np.cumprod(np.full(256, 0x100000001B3, np.uint64), dtype=np.uint64)


def term_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every term in order."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = _TERM[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = at[:-1][at[:-1] < n]
    begins[firsts] |= inside[firsts]
    start = np.flatnonzero(begins)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    kept = np.flatnonzero(inside)
    first = np.searchsorted(kept, start)
    place = np.arange(len(kept)) - np.repeat(first, np.diff(np.append(first, len(kept))))
    value = (_LOWER[raw[kept]].astype(np.uint64) + np.uint64(1)) * scramble(_POWERS[place & 255] + (place >> 8).astype(np.uint64))
    total = np.add.reduceat(value, first)
    return np.searchsorted(at, start, "right") - 1, scramble(total ^ SEED)


def distinct_terms(raw: np.ndarray, at: np.ndarray, lexicon: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash) pairs, sorted; only lexicon terms where a lexicon is given."""
    row, term = term_hashes(raw, at)
    if lexicon is not None:
        if not len(lexicon):
            return row[:0], term[:0]
        spot = np.minimum(np.searchsorted(lexicon, term), len(lexicon) - 1)
        known = lexicon[spot] == term
        row, term = row[known], term[known]
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    return row[new], term[new]


def _count(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Document frequencies within a task, by the rows' shares, merged as they grow."""
    terms, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def merged(terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, where = np.unique(np.concatenate([terms, *(t for t, _ in waiting)]), return_inverse=True)
        total = np.zeros(len(out), np.int64)
        np.add.at(total, where, np.concatenate([counts, *(c for _, c in waiting)]))
        return out, total

    for whole in batches:
        for batch in slices(whole, text):
            row, term = distinct_terms(*text_bytes(batch.column(text)), None)
            waiting.append((term, batch.column("share").to_numpy()[row]))
            if sum(len(t) for t, _ in waiting) > 500_000:
                terms, counts = merged(terms, counts)
                waiting.clear()
    if waiting:
        terms, counts = merged(terms, counts)
    for i in range(0, len(terms), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(terms[i:i + 100_000].view(np.int64)), pa.array(counts[i:i + 100_000])], names=["term", "df"])


def lexicon(docs: DataFrame, text: str = "text", min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> np.ndarray:
    """Sorted hashes of the terms inside the band."""
    # Copies share one count, so that the texts themselves need not be brought together.
    h = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    kinds = work_table(docs.groupBy(h.alias("h")).agg(F.count("*").alias("copies")), "imatch-copies")
    n, copied = kinds.count(), kinds.filter("copies > 1")
    copied = F.broadcast(copied) if copied.count() <= BROADCAST_ROWS else copied
    rows = docs.select(F.col(text), h.alias("h")).join(copied, "h", "left")
    rows = rows.select(text, F.floor(F.lit(WHOLE) / F.coalesce("copies", F.lit(1))).cast("bigint").alias("share"))
    df = rows.mapInArrow(lambda it: _count(it, text), "term bigint, df bigint").groupBy("term").agg(F.round(F.sum("df") / F.lit(WHOLE)).alias("df"))
    band = df.filter((F.col("df") >= F.lit(min_share * n)) & (F.col("df") <= F.lit(max_share * n)))
    return np.sort(band.select("term").toPandas()["term"].to_numpy(np.int64).view(np.uint64))


def fingerprints(raw: np.ndarray, at: np.ndarray, lex: np.ndarray, subsets: int = SUBSETS) -> list[str]:
    """One string per row: level, then 16-bit hashes of the subsets at that level and the next; '----' where a subset is empty."""
    rows = len(at) - 1
    row, term = distinct_terms(raw, at, None)
    if len(lex):
        known = lex[np.minimum(np.searchsorted(lex, term), len(lex) - 1)] == term
        kept = known | (np.bincount(row[known], minlength=rows) == 0)[row]
        row, term = row[kept], term[kept]
    count = np.bincount(row, minlength=rows)
    level = np.clip(np.floor(np.log2(2 * np.maximum(count, 1)) / 2).astype(np.int64), 0, MAX_LEVEL)
    out = np.zeros((rows, 2 * subsets), np.uint64)
    seen = np.zeros((rows, 2 * subsets), bool)
    for k in range(subsets):
        draw = scramble(term ^ scramble(np.full(1, 7919 * (k + 1), np.uint64)))
        for j in (0, 1):
            # At level L a term is in with chance 4^-L: the draw's lowest 2L bits are zero.
            mask = (np.uint64(1) << (2 * (level[row] + j)).astype(np.uint64)) - np.uint64(1)
            kept = np.flatnonzero((draw & mask) == 0)
            if len(kept):
                at_row = row[kept]
                first = np.flatnonzero(np.concatenate(([True], at_row[1:] != at_row[:-1])))
                # The terms stand sorted and distinct, so their sum of mixed values stands for the set.
                total = scramble(np.add.reduceat(scramble(term[kept] + np.uint64(k + 1)), first))
                out[at_row[first], j * subsets + k] = total & np.uint64(0xFFFF)
                seen[at_row[first], j * subsets + k] = True
    result = []
    for r in range(rows):
        if not count[r]:
            result.append("=" + hashlib.sha256(raw[at[r]:at[r + 1]].tobytes()).hexdigest()[:32])
            continue
        cells = ["%04x" % v if s else "----" for v, s in zip(out[r].tolist(), seen[r].tolist(), strict=True)]
        result.append(f"{level[r]}:" + "".join(cells))
    return result


def likeness(a: str, b: str, subsets: int = SUBSETS) -> float:
    """Share of equal hashes among the subsets, at a level both have, in which either is not empty."""
    if a[0] == "=" or b[0] == "=":
        return float(a == b)
    (la, _, ca), (lb, _, cb) = a.partition(":"), b.partition(":")
    gap = int(lb) - int(la)
    if abs(gap) > 1:
        return 0.0
    width = 4 * subsets
    sa = ca[width:] if gap == 1 else ca[:width]
    sb = cb[width:] if gap == -1 else cb[:width]
    pairs = [(sa[i:i + 4], sb[i:i + 4]) for i in range(0, width, 4)]
    some = [x == y for x, y in pairs if x != "----" or y != "----"]
    return sum(some) / len(some) if some else float(a == b)


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every row."""
    lex = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text, min_share, max_share))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, 1 << 20):
                raw, at = text_bytes(batch.column(text))
                yield pa.RecordBatch.from_arrays([batch.column(doc_id), pa.array(fingerprints(raw, at, lex.value))], names=[doc_id, "fingerprint"])

    return docs.select(doc_id, text).mapInArrow(each, f"`{doc_id}` {docs.schema[doc_id].dataType.simpleString()}, fingerprint string")


def _edited(batches: Iterator[pa.RecordBatch], lex: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (range, place); the next row of the same range is the next document."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    held: tuple | None = None
    queue: list[tuple] = []

    def flush() -> pa.RecordBatch:
        edited = [own[: len(own) - len(own) // 4] + nxt[: len(own) // 4] for _, own, nxt in queue]
        # A successor is mostly the next row of the queue; only others are fingerprinted once more.
        inside = [i + 1 < len(queue) and queue[i + 1][1] is nxt for i, (_, _, nxt) in enumerate(queue)]
        other = [nxt for (_, _, nxt), known in zip(queue, inside, strict=True) if not known]
        marks = fingerprints(*text_bytes(pa.array([own for _, own, _ in queue] + edited + other, pa.large_string())), lex)
        extra = iter(marks[2 * len(queue):])
        cols: list[list] = [[] for _ in names]
        for i, (doc, own, _) in enumerate(queue):
            mine, changed = marks[i], marks[len(queue) + i]
            following = marks[i + 1] if inside[i] else next(extra)
            sha = hashlib.sha256(edited[i].encode()).hexdigest()
            for col, v in zip(cols, (doc, len(own), sha, mine, changed, likeness(mine, changed), likeness(mine, following)), strict=True):
                col.append(v)
        queue.clear()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    size = 0
    for batch in batches:
        for part, ahead, doc, text in zip(*(batch.column(c).to_pylist() for c in ("part", "ahead", "doc", "text")), strict=True):
            text = text or ""
            if held is not None and held[0] == part:
                queue.append((held[1], held[2], text))
                size += 2 * len(held[2]) + len(text)
                if size > 1 << 20:
                    yield flush()
                    size = 0
            held = None if ahead else (part, doc, text)
    if queue:
        yield flush()


def edit_report(docs: DataFrame, parts: int | None = None, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness.

    Documents are dealt into ranges of ids; the first document of each range also goes, marked, to the range before (the
    very first one to the last range), so every document meets its successor without a global sort.
    """
    spark = docs.sparkSession
    lex = spark.sparkContext.broadcast(lexicon(docs, "text", min_share, max_share))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = F.lit(-(1 << 63))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), low).alias("d"), F.xxhash64("text").alias("h"))
    ids = work_table(ids, "imatch-ids")
    cuts = ids.agg(F.percentile_approx("d", F.array(*[F.lit(i / parts) for i in range(1, parts)]), 10_000)).first()[0] if parts > 1 else []
    bounds = F.array(*[F.lit(c).cast("bigint") for c in sorted(set(cuts or []))]).cast("array<bigint>")
    part_of = lambda d: F.size(F.filter(bounds, lambda c: c <= d))
    # One row per range: its first document.  Equal ids go by a hash of their text.
    firsts = ids.groupBy(part_of(F.col("d")).alias("part")).agg(F.min(F.struct("d", "h")).alias("first")).orderBy("part").collect()
    before = {r["part"]: firsts[i - 1]["part"] for i, r in enumerate(firsts)}
    d, h = F.coalesce(F.col("doc_id").cast("bigint"), low), F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc"), "text", d.alias("d"), h.alias("h")).withColumn("part", part_of(F.col("d")))
    also = F.lit(None).cast("int")
    for r in firsts:
        at = (F.col("part") == r["part"]) & (F.col("d") == r["first"]["d"]) & (F.col("h") == r["first"]["h"])
        also = F.when(at, F.lit(before[r["part"]])).otherwise(also)
    own = F.struct(F.col("part").alias("to"), F.lit(False).alias("ahead"))
    copy = F.struct(F.col("also").alias("to"), F.lit(True).alias("ahead"))
    dealt = rows.withColumn("also", also).withColumn("go", F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, copy))))
    dealt = dealt.select(F.col("go.to").alias("part"), F.col("go.ahead").alias("ahead"), "doc", "d", "h", "text")
    lined = dealt.repartitionByRange(max(1, len(firsts)), "part").sortWithinPartitions("part", "ahead", "d", "h")
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return lined.select("part", "ahead", "doc", "text").mapInArrow(lambda it: _edited(it, lex.value), schema)


def op10_query(docs: DataFrame) -> DataFrame:
    return edit_report(docs)
