"""Language identification by interpolated Kneser-Ney character models.

For every language an order-``ORDER`` character model is estimated with absolute discounting and continuation counts,
interpolated down to a uniform distribution.  N-grams are 64-bit hashes in sorted arrays; per n-gram the arrays hold the
discounted probability in each language, per context the weight that falls to the shorter context.  The language with the
least cross-entropy per character is predicted.  Rejection is calibrated: the cross-entropy a text of a given length
may have under its own language is learned from the training texts.

Texts are lower-cased; runs of anything but letters become one boundary character, so numbers, marks and layout play no part.

The models are fitted on at most about ``SAMPLE`` labelled documents per language (drawn by a hash of the id), which bounds
the arrays that are broadcast; every document is scored, whole.

Defined cases: a null text, or one without letters, is ``und`` with score 0; null labels are not learned from; null ids count
as held in (their crc32 is that of an empty text); repeated rows each get the same answer; without any
labelled text every document is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.config import work_table
from trailmark.llm.common import held_out

ORDER = 4
SAMPLE = 4000  # labelled documents per language
DISCOUNT = 0.75
UNIVERSE = 2000  # characters the uniform distribution spreads over
CHUNK = 1 << 20  # characters handled at once
LIMIT_SIGMAS = 10.0
FLOOR = 0.3  # bits a character, the least spread
POOLED = 5  # texts of all languages that each language's limits are pulled towards
UNKNOWN = "und"

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)


def _hash_step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hash of a sequence one character longer."""
    h = (h ^ (c + np.uint64(1))) * _A
    return (h ^ (h >> np.uint64(29))) * _B


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, letters lower-cased and the rest cut to single boundaries (0), each text begun by one; row offsets."""
    joined, bounds, total = [], [0], 0
    for t in texts:
        t = "\n" + (t or "").lower()
        joined.append(t)
        total += len(t)
        bounds.append(total)
    points = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    distinct, where = _factorize(points)
    is_letter = np.array([chr(c).isalpha() for c in distinct.tolist()], bool)
    coded = np.where(is_letter, distinct, 0).astype(np.uint32)[where]
    keep = np.ones(len(coded), bool)
    keep[1:] = (coded[1:] != 0) | (coded[:-1] != 0)
    begins = np.array(bounds[:-1], np.int64)
    keep[begins] = True
    offsets = np.concatenate(([0], np.cumsum(keep)))[np.array(bounds)]
    return coded[keep], offsets


def _factorize(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    where, distinct = pd.factorize(values)
    return distinct, where


def tails(points: np.ndarray, at: np.ndarray, where: np.ndarray | None = None) -> list[np.ndarray]:
    """The character at each position (or those in ``where``), the one before it, and so on; boundaries before a row begins."""
    spots = np.arange(len(points)) if where is None else where
    begin = np.repeat(at[:-1], np.diff(at))[spots]
    out = [points[spots].astype(np.uint64)]
    for back in range(1, ORDER):
        prev = spots - back
        out.append(np.where(prev >= begin, points[np.maximum(prev, 0)], 0).astype(np.uint64))
    return out


def fold(seed: int, chars: list[np.ndarray]) -> np.ndarray:
    """Hash of a character sequence given last character first."""
    h = np.full(len(chars[0]) if chars else 1, seed, np.uint64)
    for c in reversed(chars):
        h = _hash_step(h, c)
    return h


def _chunks(texts: list[str | None], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > limit:
            yield start, i
            start, size = i, 0
        size += len(t or "")
    if start < len(texts):
        yield start, len(texts)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, c0, c1, ..., seen): counts of the longest n-grams, last character first."""
    for batch in batches:
        for lang, own in batch.groupby("lang"):
            texts = own["text"].tolist()
            for a, b in _chunks(texts):
                points, at = letters(texts[a:b])
                inside = np.ones(len(points), bool)
                inside[at[:-1]] = False  # the boundary before a text is given, not predicted
                spots = np.flatnonzero(inside)
                _, first, seen = np.unique(fold(ORDER, tails(points, at))[spots], return_index=True, return_counts=True)
                chars = tails(points, at, spots[first])
                yield pd.DataFrame({"lang": lang, **{f"c{i}": c.astype(np.int64) for i, c in enumerate(chars)}, "seen": seen})


@dataclass(frozen=True)
class Models:
    """Per order: sorted n-gram hashes with discounted probabilities, sorted context hashes with back-off weights (one column per language)."""

    langs: list[str]
    gram: list[np.ndarray]
    p: list[np.ndarray]
    ctx: list[np.ndarray]
    rest: list[np.ndarray]
    limits: np.ndarray | None = None

    def log2p(self, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which, table): row ``which[i]`` of ``table`` has the log2 probabilities of character i in every language."""
        distinct, which = _factorize(fold(ORDER, tails(points, at)))
        first = np.empty(len(distinct), np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        last = tails(points, at, first)
        prob = np.full((len(distinct), len(self.langs)), 1 / UNIVERSE)
        for n in range(1, ORDER + 1):
            own, rest = _find(self.gram[n - 1], fold(n, last[:n])), _find(self.ctx[n - 1], fold(n, last[1:n]) if n > 1 else np.full(len(first), n, np.uint64))
            # Without the context in a language, the shorter context decides alone (weight 1).
            prob = self.p[n - 1][own] + self.rest[n - 1][rest] * prob
        return which, np.log2(prob)


def _find(sorted_hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each hash, or the last row, which stands for absent."""
    if not len(sorted_hashes):
        return np.zeros(len(wanted), np.int64)
    spot = np.minimum(np.searchsorted(sorted_hashes, wanted), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[spot] == wanted, spot, len(sorted_hashes))


def build(counts: pd.DataFrame, langs: list[str]) -> Models:
    """Kneser-Ney estimates from counts of the longest n-grams (lang, c0, c1, ..., seen)."""
    counts = counts.assign(lang=counts["lang"].map({lang: i for i, lang in enumerate(langs)}))
    out: dict[str, list[np.ndarray]] = {"gram": [], "p": [], "ctx": [], "rest": []}
    names = [f"c{i}" for i in range(ORDER)]
    own = counts.rename(columns={"seen": "c"})
    for n in range(ORDER, 0, -1):
        if n < ORDER:
            # Below the top, an n-gram counts once for every character seen before it.
            own = own.groupby(["lang", *names[:n]]).size().rename("c").reset_index()
        chars = [own[c].to_numpy(np.int64).astype(np.uint64) for c in names[:n]]
        gram = fold(n, chars)
        ctx = fold(n, chars[1:]) if n > 1 else np.full(len(own), n, np.uint64)
        lang, c = own["lang"].to_numpy(), own["c"].to_numpy(float)
        held, spot = np.unique(ctx, return_inverse=True)
        total, kinds = np.zeros((len(held), len(langs))), np.zeros((len(held), len(langs)))
        np.add.at(total, (spot, lang), c)
        np.add.at(kinds, (spot, lang), 1)
        rest = np.ones((len(held) + 1, len(langs)))
        rest[:-1] = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        seen, where = np.unique(gram, return_inverse=True)
        p = np.zeros((len(seen) + 1, len(langs)))
        p[where, lang] = np.maximum(c - DISCOUNT, 0) / total[spot, lang]
        for name, value in (("gram", seen), ("p", p), ("ctx", held), ("rest", rest)):
            out[name].insert(0, value)
    return Models(langs, out["gram"], out["p"], out["ctx"], out["rest"])


def cross_entropy(models: Models, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, predicted characters per row, and bits per character in every language."""
    for a, b in _chunks(texts):
        points, at = letters(texts[a:b])
        which, table = models.log2p(points, at)
        n = np.diff(at) - 1
        bits = np.zeros((b - a, len(models.langs)))
        for k in range(len(models.langs)):
            column = table[:, k][which]
            column[at[:-1]] = 0
            bits[:, k] = -np.add.reduceat(column, at[:-1])
        has_letter = np.add.reduceat(points != 0, at[:-1]) > 0
        yield a, b, np.where(has_letter, n, 0), bits / np.maximum(n, 1)[:, None]


def predict(models: Models, texts: list[str | None]) -> pd.DataFrame:
    """Per text: ``lang``, ``score`` (0 to 1) and ``rejected``.

    The score is the posterior of the predicted language with the evidence counted per ten characters at most fifty
    times, so long texts do not all end at 1.  A text is rejected without letters, or where its cross-entropy lies beyond
    what texts of the language and length reach.
    """
    lang, score, rejected = [], [], []
    names = np.array(models.langs, object)
    for a, b, n, ce in cross_entropy(models, texts):
        best = ce.argmin(axis=1)
        least = ce[np.arange(b - a), best]
        weight = np.minimum(n, 500) / 10
        post = 1 / np.exp2(-(ce - least[:, None]) * weight[:, None]).sum(axis=1)
        some = n > 0
        mean, spread = (models.limits[best, 0], models.limits[best, 1]) if models.limits is not None else (least, 1.0)
        beyond = least > mean + LIMIT_SIGMAS * spread * np.sqrt(1 + 100 / np.maximum(n, 1))
        lang += np.where(some, names[best], UNKNOWN).tolist()
        score += np.where(some, post, 0.0).tolist()
        rejected += (~some | beyond).tolist()
    return pd.DataFrame({"lang_pred": lang, "score": score, "rejected": rejected})


def rejection_limits(lang: np.ndarray, ce: np.ndarray, langs: int) -> np.ndarray:
    """(mean, spread) per language of the cross-entropy of held-out texts.

    Each language is pulled towards all languages together as if it had ``POOLED`` more texts like theirs, so a label with few texts or
    none is judged like the others and never accepts everything.  The floor leaves room for texts that change language or spelling on
    the way; short texts get their allowance in ``predict``.
    """
    if not len(ce):
        return np.tile([np.log2(UNIVERSE), FLOOR], (langs, 1))  # nothing is known: all that has letters is accepted
    n = np.bincount(lang, minlength=langs) + POOLED
    mean = (np.bincount(lang, weights=ce, minlength=langs) + POOLED * ce.mean()) / n
    # The pooled part spreads as texts do about their own language's mean.
    own = (ce - mean[lang]) ** 2
    spread = np.sqrt((np.bincount(lang, weights=own, minlength=langs) + POOLED * own.mean()) / n)
    return np.stack([mean, np.maximum(FLOOR, spread)], 1)


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE) -> Models:
    """Models of all languages among the labelled rows where ``learn`` holds.

    N-grams are counted on executors; the driver receives the counts of the bounded sample.
    """
    labelled = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("doc"))
    per = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(per)
    if not langs:
        return Models([], [], [], [], [])
    share = F.lit(0.0)
    for name, n in per.items():
        share = F.when(F.col("lang") == name, F.lit(sample / n)).otherwise(share)
    draw = F.xxhash64(F.lit("language"), "doc", "text").bitwiseAND((1 << 40) - 1) / float(1 << 40)
    drawn = work_table(labelled.withColumn("u", draw).filter(F.col("u") < share).select("lang", "text", "u"), "language-sample")
    chars = [f"c{i}" for i in range(ORDER)]
    schema = "lang string, " + ", ".join(f"{c} bigint" for c in chars) + ", seen bigint"
    # The last tenth of the sample is kept out of the counts and used to calibrate rejection.
    held = F.pmod(F.xxhash64("u"), F.lit(10)) == 0
    counted = drawn.filter(~held).select("lang", "text").mapInPandas(_count, schema).groupBy("lang", *chars).agg(F.sum("seen").alias("seen"))
    models = build(counted.toPandas(), langs)

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["lang"].map({name: i for i, name in enumerate(models.langs)}).to_numpy()
            for a, b, n, ce in cross_entropy(models, batch["text"].tolist()):
                yield pd.DataFrame({"lang": own[a:b], "n": n, "ce": ce[np.arange(b - a), own[a:b]]})

    seen = drawn.filter(held).select("lang", "text").mapInPandas(bits, "lang int, n bigint, ce double").filter("n > 0").toPandas()
    return Models(models.langs, models.gram, models.p, models.ctx, models.rest, rejection_limits(seen["lang"].to_numpy(), seen["ce"].to_numpy(), len(langs)))


def identify(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with a struct ``found`` (lang_pred, score, rejected) per row; the row itself is in ``row``."""
    models = fit(docs, learn, text, lang, doc_id, sample)
    # Plain lists and arrays: a broadcast is unpickled without what cloudpickle would carry along.
    shared = docs.sparkSession.sparkContext.broadcast((models.langs, models.gram, models.p, models.ctx, models.rest, models.limits))

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Models(*shared.value)
        for series in texts:
            values = [t if isinstance(t, str) else None for t in series.tolist()]
            if known.langs:
                yield predict(known, values)
            else:
                yield pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "rejected": True}, index=range(len(values)))

    return docs.select(F.struct("*").alias("row"), found(F.col(text)).alias("found"))


def op4_query(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    out = held_out(F.col("doc_id"), 4)
    rows = identify(docs.select("doc_id", "text", "lang"), ~out)
    return rows.select("row.doc_id", held_out(F.col("row.doc_id"), 4).alias("held_out"), "found.lang_pred", "found.score", "found.rejected")
