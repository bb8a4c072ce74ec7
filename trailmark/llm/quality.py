"""Quality scores from document statistics: random Fourier features, ridge regression, isotonic calibration.

* Each text gives a few dozen statistics (``STATISTICS``): lengths, shares of kinds of characters and words, repetition.  They come from
  the bytes of whole texts, one pass, and are written once.
* Standardised, they pass through cosines of random directions, whose products approximate a Gaussian kernel.
* Every partition of the labelled rows sums its own normal equations, kept apart by fold.  The ridge factor is the one with the least
  squared error on left-out folds, which follows from the sums alone.
* Scores of each fold by a model that has not seen it are counted in bins with their labels.  Pooling neighbours that are out of
  order gives the monotone map from a raw score to a share of good documents; between the pools it is linear.

Models are fitted on at most about ``train_rows`` labelled rows, drawn by hash of the id; all else covers all rows.

Defined cases: a null text counts as empty, and both are scored like any text; a null id is empty text for the hold-out rule and never
joins a label; labels of one id are averaged, null ones ignored; repeated rows each get their score and each count in learning;
without any usable label the score is 0.5; an empty table gives no rows; other columns are neither used nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.config import work_table
from trailmark.llm.common import slices, text_bytes

TRAIN_ROWS = 200_000
FEATURES = 256  # random directions
BANDWIDTH = 2.0  # of the kernel, times the root of the number of statistics
FOLDS, PARTS = 5, 4  # partitions of the labelled rows: FOLDS * PARTS
RIDGE = tuple(10.0**e for e in range(-7, 0))  # factors tried, times the number of rows
BINS = 2000  # of raw scores, over [-0.5, 1.5]
CLIP = 3.0  # deviations beyond which a statistic no longer counts
PASS = 0.3  # scores of good documents start here
SEED = 77

# The contract's white space, and bytes by kind.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_UPPER, _LOWER, _DIGIT, _HIGH, _FOLLOW = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = _HIGH[128:] = _FOLLOW[128:192] = True
_LETTER = _UPPER | _LOWER | _HIGH
_COMMON, _END = np.zeros(256, bool), np.zeros(256, bool)
_COMMON[list(b".,;:!?'\"()-")] = True
_END[list(b".!?")] = True
_ODD = ~(_SPACE | _LETTER | _DIGIT | _COMMON)

STATISTICS = (
    "characters", "words", "lines", "characters_a_word", "longest_word", "spread_of_word_lengths",
    "letters", "capitals", "digits", "common_marks", "odd_marks", "spaces", "beyond_ascii", "byte_entropy",
    "words_that_end_in_marks", "words_that_end_sentences", "words_without_letters", "capitalised_words", "capital_words",
    "distinct_words", "commonest_word", "repeated_neighbours", "distinct_pairs", "distinct_lines", "words_a_line",
)


def _largest(value: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """By owner, in rising order, the largest value; zero where there is none."""
    out = np.zeros(rows)
    if len(value):
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        out[owner[first]] = np.maximum.reduceat(value, first)
    return out


def _distinct(owner: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """By owner: the number of distinct values, and the count of the commonest."""
    order = np.lexsort((value, owner))
    o, v = owner[order], value[order]
    first = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (v[1:] != v[:-1]))[:len(o)])
    return np.bincount(o[first], minlength=rows).astype(float), _largest(np.diff(np.append(first, len(o))), o[first], rows)


def _stretch_hashes(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes [first, last)."""
    if not len(first):
        return np.zeros(0, np.uint64)
    size = last - first
    at = np.repeat(first - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
    place = at - np.repeat(first, size)
    power = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
    mixed = (raw[at].astype(np.uint64) + np.uint64(1)) * power[place]
    total = np.append(np.uint64(0), np.cumsum(mixed))
    edge = np.append(0, np.cumsum(size))
    out = total[edge[1:]] - total[edge[:-1]]
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of true bytes that do not cross rows: first, end, and row."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before, after = np.append(False, inside[:-1]) if n else inside, np.append(inside[1:], False) if n else inside
    first = np.flatnonzero(inside & (~before | edge[:-1]))
    last = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return first, last, np.searchsorted(at, first, "right") - 1


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    raw, at = text_bytes(texts)
    rows = len(at) - 1
    share = lambda part, whole: part / np.maximum(whole, 1)
    histogram = np.bincount(np.repeat(np.arange(rows) * 256, np.diff(at)) + raw, minlength=rows * 256).reshape(rows, 256)
    count = lambda kind: (histogram[:, kind]).sum(1).astype(float)
    chars, letters = count(~_FOLLOW), count(_LETTER & ~_FOLLOW)
    first, last, row = _runs(~_SPACE[raw], at)
    words = np.bincount(row, minlength=rows).astype(float)
    by_word = lambda value: np.bincount(row, weights=value, minlength=rows)
    running = np.append(0, np.cumsum(~_FOLLOW[raw]))
    size = running[last] - running[first]
    running = np.append(0, np.cumsum(_LETTER[raw]))
    lettered = running[last] > running[first]
    running = np.append(0, np.cumsum(_LOWER[raw] | _HIGH[raw]))
    head, tail = raw[first], raw[last - 1]
    loud = lettered & (running[last] == running[first]) & (size > 1)
    longest = _largest(size, row, rows)
    mean = share(by_word(size), words)
    spread = np.sqrt(np.maximum(share(by_word(size.astype(float) ** 2), words) - mean**2, 0))
    word = _stretch_hashes(raw, first, last)
    kinds, top = _distinct(row, word, rows)
    pair = row[1:] == row[:-1]
    same = np.bincount(row[1:][pair & (word[1:] == word[:-1])], minlength=rows)
    pairs, _ = _distinct(row[1:][pair], (word[1:] * np.uint64(31) + word[:-1])[pair], rows)
    line_first, line_last, line_row = _runs(raw != 10, at)
    lines = np.bincount(line_row, minlength=rows).astype(float)
    line_kinds, _ = _distinct(line_row, _stretch_hashes(raw, line_first, line_last), rows)
    p = histogram / np.maximum(histogram.sum(1, keepdims=True), 1)
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    ascii_letters = count(_UPPER | _LOWER)
    return np.stack([
        np.log1p(chars), np.log1p(words), np.log1p(lines), mean, np.log1p(longest), spread,
        share(letters, chars), share(count(_UPPER), ascii_letters), share(count(_DIGIT), chars), share(count(_COMMON), chars),
        share(count(_ODD), chars), share(count(_SPACE), chars), share(chars - count(~_HIGH), chars), entropy,
        share(by_word(~(_LETTER | _DIGIT)[tail]), words), share(by_word(_END[tail] & lettered), words), share(by_word(~lettered), words),
        share(by_word(_UPPER[head]), words), share(by_word(loud), words),
        share(kinds, words), share(top, words), share(same, words), share(pairs, np.maximum(words - 1, 0)), share(line_kinds, lines),
        np.log1p(share(words, lines)),
    ], 1)


def _measure(batches: Iterator[pa.RecordBatch], key: str, text: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, text):
            found = statistics(batch.column(text))
            offsets = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(offsets, pa.array(found.reshape(-1)))], names=[key, "stats"])


@dataclass(frozen=True)
class Model:
    """What scoring needs: standardisation, random directions, weights, and the monotone map's knots."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    level: np.ndarray


def directions(width: int, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies drawn from the kernel's spectrum, and phases."""
    rng = np.random.default_rng(SEED)
    return rng.standard_normal((width, features)) / (BANDWIDTH * np.sqrt(width)), rng.uniform(0, 2 * np.pi, features)


def fourier(stats: np.ndarray, centre: np.ndarray, scale: np.ndarray, features: int = FEATURES) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    w, phase = directions(stats.shape[1], features)
    z = np.clip((stats - centre) / scale, -CLIP, CLIP)
    return np.column_stack([np.sqrt(2 / features) * np.cos(z @ w + phase), np.ones(len(z))])


def _table(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, len(STATISTICS)))


def _normal_equations(batches: Iterator[pa.RecordBatch], centre: np.ndarray, scale: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A partition's sums of z z', z y, y y and rows, by fold."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        z = np.column_stack([fourier(_table(batch.column("stats")), centre, scale), np.asarray(batch.column("label"))])
        fold = np.asarray(batch.column("fold"))
        for f in np.unique(fold):
            part = z[fold == f]
            sums[f] = sums.get(f, 0) + part.T @ part
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["fold", "sums"])


def ridge(sums: np.ndarray, factor: float) -> np.ndarray:
    """Weights from summed normal equations whose last row and column belong to the label; the constant is not shrunk."""
    gram, cross, n = sums[:-1, :-1], sums[:-1, -1], sums[-2, -2]
    shrink = np.full(len(gram), factor * n)
    shrink[-1] = 0
    return np.linalg.lstsq(gram + np.diag(shrink), cross, rcond=None)[0]


def left_out_error(folds: dict[int, np.ndarray], factor: float) -> float:
    """Sum of squared errors on each fold by the model of the others, from the sums alone."""
    total, error = sum(folds.values()), 0.0
    for s in folds.values():
        if len(folds) > 1:
            w = np.append(ridge(total - s, factor), -1.0)
            error += w @ s @ w
    return error


def isotonic(raw: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the best rising fit: neighbours out of order are pooled to their mean."""
    pools: list[list[float]] = []  # sum of weighted raw, sum of good, weight
    for x, g, w in zip(raw, good, weight):
        pools.append([x * w, g, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _raw_bins(batches: Iterator[pa.RecordBatch], centre: np.ndarray, scale: np.ndarray, weights: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        z, fold = fourier(_table(batch.column("stats")), centre, scale), np.asarray(batch.column("fold"))
        raw = np.zeros(len(z))
        for f in np.unique(fold):
            raw[fold == f] = z[fold == f] @ weights[f]
        place = np.clip(np.floor((raw + 0.5) * (BINS / 2)), 0, BINS - 1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("label")], names=["bin", "label"])


def fit(measured: DataFrame, labels: DataFrame, learns: Column, key: str = "doc_id", train_rows: int = TRAIN_ROWS) -> Model | None:
    """Learn from the labelled rows of ``measured`` for which ``learns`` holds; nothing where there are none."""
    marks = (
        labels.filter(F.col("quality").isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("label_id"), "quality")
        .groupBy("label_id").agg(F.avg(F.when(F.col("quality") > 0, 1.0).otherwise(0.0)).alias("label"))
    )
    joined = measured.filter(learns).join(marks, measured[key] == marks["label_id"]).select(F.xxhash64(key).alias("h"), "stats", "label")
    labelled = work_table(joined, "quality-labelled")
    n = labelled.count()
    if not n:
        return None
    draw = F.pmod(F.shiftright("h", 20), F.lit(1 << 30)) < int(min(1.0, train_rows / n) * (1 << 30))
    train = (
        labelled.filter(draw).withColumn("fold", F.pmod("h", F.lit(FOLDS)).cast("int"))
        .withColumn("part", F.pmod(F.shiftright("h", 8), F.lit(PARTS)).cast("int"))
        .repartition(FOLDS * PARTS, "fold", "part").sortWithinPartitions("h", "label", "stats").drop("part")
    )
    train = work_table(train, "quality-train")
    moments = train.agg(*[f(F.col("stats")[i]) for f in (F.avg, F.stddev_pop) for i in range(len(STATISTICS))]).first()
    if moments[0] is None:
        return None
    centre, scale = np.array(moments[:len(STATISTICS)]), np.array(moments[len(STATISTICS):])
    scale = np.where(scale > 1e-9, scale, 1.0)
    side = FEATURES + 2
    folds: dict[int, np.ndarray] = {}
    for fold, data in sorted(map(tuple, train.mapInArrow(lambda it: _normal_equations(it, centre, scale), "fold int, sums binary").collect())):
        folds[fold] = folds.get(fold, 0) + np.frombuffer(data).reshape(side, side)
    factor = min(RIDGE, key=lambda r: left_out_error(folds, r)) if len(folds) > 1 else RIDGE[-1]
    total = sum(folds.values())
    others = {f: ridge(total - s if len(folds) > 1 else s, factor) for f, s in folds.items()}
    bins = (
        train.mapInArrow(lambda it: _raw_bins(it, centre, scale, others), "bin int, label double")
        .groupBy("bin").agg(F.sum("label"), F.count("*")).orderBy("bin").collect()
    )
    at, good, weight = (np.array(c, float) for c in zip(*map(tuple, bins)))
    raw, level = isotonic((at + 0.5) * (2 / BINS) - 0.5, good, weight)
    return Model(centre, scale, ridge(total, factor), raw, np.clip(level, 0, 1))


def _score(batches: Iterator[pa.RecordBatch], key: str, model: tuple | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if model is None:
            score = np.full(batch.num_rows, 0.5)
        else:
            centre, scale, weights, raw, level = model
            score = np.interp((fourier(_table(batch.column("stats")), centre, scale) * weights).sum(1), raw, level)
        yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(score)], names=[key, "score"])


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The statistics of each text, written once."""
    kind = docs.schema[key].dataType.simpleString()
    return work_table(docs.select(key, text).mapInArrow(lambda it: _measure(it, key, text), f"`{key}` {kind}, stats array<double>"), "quality-stats")


def score(measured: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """Id and score of each measured text."""
    kind = measured.schema[key].dataType.simpleString()
    plain = None if model is None else (model.centre, model.scale, model.weights, model.raw, model.level)
    return measured.select(key, "stats").mapInArrow(lambda it: _score(it, key, plain), f"`{key}` {kind}, score double")


def in_test(doc_id: Column) -> Column:
    """Whether crc32 of the id's text is divisible by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op13_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a model of the labels of those not held out."""
    measured = measure(docs)
    scored = score(measured, fit(measured, labels, ~in_test(F.col("doc_id"))))
    return scored.select(
        "doc_id", in_test(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PASS).cast("int").alias("predicted"))
