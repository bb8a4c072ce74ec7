"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q, at least ``max(12, 2 * q)`` words long, that cannot grow at either
end.  Where words q apart are equal over a run of 2q words, they are so at q places in a row at least.  So at scale k,
which takes the periods from 2^k up to 2^(k+1) - 1, such a row of places holds a whole aligned block of 2^(k-1) words.
For each block, a number-theoretic transform convolves it with the windows that follow: the sum of squared differences

    sum (b[j] - w[t + j])^2  =  sum b[j]^2  +  sum w[t + j]^2  -  2 * sum b[j] * w[t + j]

is known, in integers modulo a prime, at all distances of the scale at once.  It is zero wherever the block occurs again;
nothing is lost, and the rare sum that is zero by chance falls to the next step.  Distances of neighbouring blocks are
joined and seed an extension, which compares words and so is exact.  Of equal stretches the least period is kept.

Texts are transformed together, parted by marks that equal nothing else, so a short text costs no call of its own.
The work is O(n log^2 n) for n words, whatever repeats: extensions that would cost more than a pass over the words go
through names of dyadic stretches, 4 bytes a word and level.  Transforms end at 2^16, so a text of over 2^17 words costs
some n^2 / 2^15 more.

Defined cases: a null text counts as empty and has no runs, a text under 12 words has none either; repeated rows each get
the same result; a null id counts as an empty id in the query; an empty table gives no rows; columns other than the
two named are not returned.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import SPACE, slices

LEAST = 12  # words in a run
WIDEST = 1 << 15  # words in a block; beyond, more windows follow it
CELLS = 1 << 16  # numbers transformed at a time
TOGETHER = 1 << 20  # bytes of texts taken together

# The prime 2^16 + 1 and a generator of its units.
PRIME, ROOT = 65537, 3
_INVERSE = np.uint64(pow(PRIME, -1, 1 << 64))  # times a multiple of the prime gives the quotient, at most the next number
_QUOTIENTS = np.uint64(((1 << 64) - 1) // PRIME)


_KNOWN: dict[tuple[int, bool], np.ndarray] = {}


def _twiddles(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order ``2 * half``."""
    if (half, inverse) in _KNOWN:
        return _KNOWN[half, inverse]
    root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(1, np.int64)
    while len(out) < half:
        out = np.concatenate([out, out * pow(root, len(out), PRIME) % PRIME])
    _KNOWN[half, inverse] = out
    return out


def _fold(x: np.ndarray, spare: np.ndarray | None = None) -> np.ndarray:
    """In place, the same residue 16 bits shorter: 2^16 is -1 modulo the prime."""
    high = np.right_shift(x, 16, out=spare)
    x &= 0xFFFF
    x -= high
    return x


def _stage(x: np.ndarray, twiddle: np.ndarray, forward: bool) -> np.ndarray:
    """One layer of butterflies on the pairs of axis 1.  Sums grow by a bit a layer, 16 layers stay far below 64 bits."""
    a, b = x[:, 0], x[:, 1]
    out = np.empty_like(x)
    up, down = out[:, 0], out[:, 1]
    if forward:
        np.subtract(a, b, out=down)
        down *= twiddle
        _fold(down, up)
        np.add(a, b, out=up)
    else:
        part = b * twiddle
        _fold(part, up)
        np.add(a, part, out=up)
        np.subtract(a, part, out=down)
    return out


def _forward(x: np.ndarray) -> np.ndarray:
    """Transform of the rows, left as (tile, cells / tile) in the order the layers leave."""
    cells, n = x.size, x.shape[1]
    tile, half = min(n, 16), n // 2
    flat = x
    while half:
        if half == tile // 2:  # short layers run along the other axis
            flat = np.ascontiguousarray(flat.reshape(cells // tile, tile).T)
        if half >= tile:
            flat = _stage(flat.reshape(cells // (2 * half), 2, half), _twiddles(half, False), True)
        else:
            flat = _stage(flat.reshape(tile // (2 * half), 2, half, cells // tile), _twiddles(half, False)[:, None], True)
        half //= 2
    return _fold(_fold(flat.reshape(tile, cells // tile)))


def _backward(x: np.ndarray, n: int) -> np.ndarray:
    """Inverse of ``_forward`` times ``n``, as rows of length ``n``."""
    cells, half, tile = x.size, 1, min(n, 16)
    flat = x
    while half < n:
        if half == tile:
            flat = np.ascontiguousarray(flat.reshape(tile, cells // tile).T)
        if half >= tile:
            flat = _stage(flat.reshape(cells // (2 * half), 2, half), _twiddles(half, True), False)
        else:
            flat = _stage(flat.reshape(tile // (2 * half), 2, half, cells // tile), _twiddles(half, True)[:, None], False)
        half *= 2
    if n == tile:
        flat = np.ascontiguousarray(flat.reshape(tile, cells // tile).T)
    return flat.reshape(-1, n)


def occurrences(words: np.ndarray, at: np.ndarray, block: int, n: int, offsets: range) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of each block from ``at`` in the windows of ``n`` words that begin ``offsets`` behind its start.

    ``words`` are residues and reach as far as all windows.  Windows that blocks share are transformed once.
    """
    power = np.cumsum(np.append(0, words * words % PRIME))
    energy = (power[block:] - power[:-block]) % PRIME * (n // 2) % PRIME  # times n / 2: the product comes n-fold, and twice
    blocks = np.lib.stride_tricks.sliding_window_view(words, block)
    windows = np.lib.stride_tricks.sliding_window_view(words, n)
    places = n - block + 1
    energies = np.lib.stride_tricks.sliding_window_view(energy, places)
    rows = max(1, CELLS // n)
    starts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first in range(0, len(at), rows):
        s = at[first:first + rows]
        reverse = np.zeros((len(s), n), np.int64)
        reverse[:, :block] = blocks[s][:, ::-1]
        needle = _forward(reverse).reshape(-1, len(s), max(1, n // 16)) if n > 16 else _forward(reverse)
        for few in range(0, len(offsets), 4):
            some = offsets[few:few + 4]
            begin = np.unique(s[:, None] + np.array(some))
            hay = _forward(windows[begin])
            hay = hay.reshape(-1, len(begin), max(1, n // 16)) if n > 16 else hay
            for offset in some:
                where = np.searchsorted(begin, s + offset)
                product = _fold(np.multiply(hay[:, where], needle)).reshape(min(n, 16), -1)
                cross = _backward(product, n)[:, block - 1:]
                rest = energies[s + offset] + energy[s][:, None] - cross + (PRIME << 40)
                row, shift = np.nonzero(rest.astype(np.uint64) * _INVERSE <= _QUOTIENTS)
                starts.append(s[row])
                found.append(shift + offset)
    return np.concatenate(starts), np.concatenate(found)


class _Names:
    """Names of all stretches of 2^level words: equal names, equal words.  Levels are made when first asked for."""

    def __init__(self, words: np.ndarray):
        self.levels = [np.unique(words, return_inverse=True)[1].astype(np.int32)]
        self.top = max(0, int(len(words)).bit_length() - 1)

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            last, half = self.levels[-1].astype(np.int64), 1 << (len(self.levels) - 1)
            pair = last[:-half] * (int(last.max()) + 1) + last[half:]
            self.levels.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))
        return self.levels[k]


def _reach(words: np.ndarray, names: list, low: np.ndarray, high: np.ndarray, back: bool) -> np.ndarray:
    """How many words from ``low`` and ``high`` on (before them, if ``back``) are equal one by one.

    Compares directly while that costs less than a pass over the words, and then by names.
    """
    n, side = len(words), -1 if back else 1
    got = np.zeros(len(low), np.int64)
    live = np.arange(len(low))
    step = 16
    while len(live) and len(live) * step <= max(n, 1 << 14):
        shift = got[live][:, None] + np.arange(step)
        i, j = low[live][:, None] + side * shift - back, high[live][:, None] + side * shift - back
        same = (i >= 0) & (j < n)
        same &= words.take(i, mode="clip") == words.take(j, mode="clip")
        whole = same.all(1)
        got[live] += np.where(whole, step, same.argmin(1))
        live = live[whole]
        step *= 2
    if len(live):
        if not names:
            names.append(_Names(words))
        for k in range(names[0].top, -1, -1):
            size, name = 1 << k, names[0].level(k)
            i, j = low[live] + side * got[live] - back * size, high[live] + side * got[live] - back * size
            ok = (i >= 0) & (j + size <= n)
            ok[ok] = name[i[ok]] == name[j[ok]]
            got[live[ok]] += size
    return got


def _stretches(words: np.ndarray, names: list, start: np.ndarray, period: np.ndarray, block: int) -> np.ndarray:
    """Maximal (start, end, period) around the seeds; seeds of neighbouring blocks at one distance count as one."""
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] != start[:-1] + block)
    first, period = start[new], period[new]
    last = np.append(start[np.flatnonzero(new)[1:] - 1], start[-1:]) if len(start) else start
    out = [np.zeros((0, 3), np.int64)]
    while len(first):
        after = _reach(words, names, first, first + period, False)
        before = _reach(words, names, first, first + period, True)
        out.append(np.stack([first - before, first + after + period, period], 1))
        # A chance zero inside joined seeds: go on behind what was really equal.
        first = first + np.maximum(after // block, 1) * block
        more = first <= last
        first, last, period = first[more], last[more], period[more]
    return np.concatenate(out)


def _scales(longest: int) -> Iterator[tuple[int, int, int, int, range]]:
    """(least period, end of periods, words in a block, length of a transform, offsets of windows) as far as a text can need.

    Periods below 7 have at least 6 places in a row, as a run has 12 words.
    """
    yield 1, 7, 3, 8, range(1, 2)
    yield 7, 16, 4, 8, range(4, 16, 4)
    k = 4
    while 2 << k <= longest:
        block = min(1 << (k - 1), WIDEST)
        yield 1 << k, 2 << k, block, 2 * block, range(1 << k, 2 << k, block)
        k += 1


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Runs of each text (numbers for words) as rows of (start, length, period), by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(np.append(0, sizes + 1))  # a mark follows each text
    longest = int(sizes.max(initial=0))
    none = np.zeros((0, 3), np.int64)
    if longest < LEAST:
        return [none for _ in texts]
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    # No window reaches further than twice the longest text beyond its block.
    whole = np.arange(top, top + begin[-1] + 3 * longest + 64, dtype=np.int64)
    for t, b in zip(texts, begin):
        whole[b:b + len(t)] = t
    residues, words, names, out = whole % PRIME, whole[:begin[-1]], [], [none]
    for low, high, block, n, offsets in _scales(longest):
        at = np.arange(0, len(words), block)
        own = np.searchsorted(begin, at, "right") - 1
        fits = (sizes[own] >= max(LEAST, 2 * low)) & (at + low + block <= begin[own] + sizes[own])
        start, distance = occurrences(residues, at[fits], block, n, offsets)
        own = np.searchsorted(begin, start, "right") - 1
        inside = (distance >= low) & (distance < high) & (start + distance + block <= begin[own] + sizes[own])
        found = _stretches(words, names, start[inside], distance[inside], block)
        out.append(found[found[:, 1] - found[:, 0] >= np.maximum(LEAST, 2 * found[:, 2])])
    runs = np.concatenate(out)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)  # the least period of each stretch
    runs = runs[new]
    own = np.searchsorted(begin, runs[:, 0], "right") - 1
    runs = np.stack([runs[:, 0] - begin[own], runs[:, 1] - runs[:, 0], runs[:, 2]], 1)
    order = np.lexsort((runs[:, 2], runs[:, 0], own))
    runs, own = runs[order], own[order]
    cut = np.searchsorted(own, np.arange(len(texts) + 1))
    return [runs[a:b] for a, b in zip(cut[:-1], cut[1:])]


def _collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words without what lies in a run behind its first period."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words).decode()


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch], id_name: str, text: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, text, TOGETHER):
            number = defaultdict(count().__next__)
            split = [(v.as_py() or "").encode().split() for v in batch.column(text)]  # splits at the contract's six bytes
            found = find_runs([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in split])
            flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
            offsets = np.cumsum([0, *map(len, found)])
            runs = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(RUN)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_name), pa.array([len(w) for w in split], pa.int64()), runs,
                 pa.array([_collapsed(w, r) for w, r in zip(split, found)], pa.string())],
                names=[id_name, "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its words counted, its runs by start and period, and the text with each run cut to one period."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"`{doc_id}` {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.select(doc_id, text).mapInArrow(lambda it: _scan(it, doc_id, text), schema)


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The contract's texts: in a tenth of the documents the words from some place on repeat with a period."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(text, SPACE), "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    cycle = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    changed = F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(cycle), F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(changed, " ")).otherwise(text)


def op11_query(docs: DataFrame) -> DataFrame:
    """Digests of the runs and of the collapsed texts of all documents."""
    texts = docs.select("doc_id", with_planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return (
        periodic_runs(texts)
        .withColumn("longest", longest)
        .select(
            "doc_id", F.size("runs").cast("long").alias("n_runs"),
            (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
            F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).alias("exponent_milli"),
            F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )
