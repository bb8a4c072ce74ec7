"""Benchmark decontamination: a hash set of benchmark word windows against all document windows.

Benchmark items are normalised to lower-case words and cut into windows of ``width`` consecutive
words; an item of fewer words, but not none, is one window.  Document windows of the same lengths
are looked up by hash in the set of benchmark windows and verified word by word, all in built-in
functions.  The set is broadcast while it has at most ``max_broadcast_windows`` entries and joined
by shuffle beyond that, with the same result.

Defined cases: a null or empty text has no words and is never hit; null ids form rows of their own;
repeated rows each get the same result; an empty benchmark or an empty table gives no hits; columns
other than id and text are never looked at, and filters hand them back untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.config import work_table
from trailmark.llm.common import ascii_lower, row_key, words

MAX_BROADCAST_WINDOWS = 200_000
BROADCAST_KEYS = 1_000_000  # of an id and a hash each


def _windows(tokens: Column, width: int) -> Column:
    """All windows of ``width`` words as (pos, len, hash, gram)."""
    n = F.size(tokens)
    at = lambda i: F.struct(
        i.alias("pos"), F.lit(width).alias("len"), F.array_join(F.slice(tokens, i + 1, width), " ").alias("gram"),
    )
    return F.when(n >= width, F.transform(F.sequence(F.lit(0), n - width), at))


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", width: int = 10) -> DataFrame:
    """One row per distinct (hash, gram, item) of the benchmark."""
    items = benchmark.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(width))
    starts = F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("i")
    return (
        items.select("item", "w", size.alias("len"), starts)
        .select("item", "len", F.array_join(F.slice("w", F.col("i") + 1, F.col("len")), " ").alias("gram"))
        .withColumn("hash", F.xxhash64("gram")).distinct()
    )


def occurrences(docs: DataFrame, grams: DataFrame, doc_id: str, text: str, max_broadcast_windows: int) -> DataFrame:
    """Verified places: (key, pos, len, hash, gram), one row per document window that is a benchmark window."""
    known = grams.select("hash", "gram", "len").distinct()
    lengths = {r["len"]: r["n"] for r in known.groupBy("len").agg(F.count("*").alias("n")).collect()}
    keyed = docs.select(row_key(F.col(doc_id), F.col(text)).alias("key"), words(F.col(text)).alias("w"))
    scans = [_windows(F.col("w"), n) for n in sorted(lengths)]
    if not scans:
        scans = [_windows(F.col("w"), 1)]
    empty = F.array().cast("array<struct<pos:int,len:int,gram:string>>")
    scan = keyed.select("key", F.explode(F.concat(*[F.coalesce(s, empty) for s in scans])).alias("x"))
    scan = scan.select("key", "x.pos", "x.gram", F.xxhash64("x.gram").alias("hash"))
    known = known.withColumnRenamed("gram", "known")
    side = F.broadcast(known) if sum(lengths.values()) <= max_broadcast_windows else known
    return scan.join(side, "hash").filter(F.col("gram") == F.col("known")).drop("known")


def decontamination_report(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = 10, max_broadcast_windows: int = MAX_BROADCAST_WINDOWS,
) -> DataFrame:
    """Per hit document key: hit words, items (sorted as strings), and the hit spans [from, to) in words.

    A word inside any occurrence counts once.  Documents without hits have no row.
    """
    grams = benchmark_windows(benchmark, item_id, item_text, width)
    # Read twice below; hits are few, scanning for them is not.
    hits = work_table(occurrences(docs, grams, doc_id, text, max_broadcast_windows), "benchmark-hits")
    places = hits.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("pos", "len"))).alias("places"))
    place = F.struct(F.col("places.pos").getItem(0).alias("from"), (F.col("places.pos").getItem(0) + F.col("places.len").getItem(0)).alias("to"))
    none = F.array().cast("array<struct<from:int,to:int>>")
    # Places come in order, so one pass joins those that touch: the open span and the closed ones.
    start = F.struct(none.alias("done"), place.getField("from").alias("from"), place.getField("to").alias("to"))

    def step(s: Column, x: Column) -> Column:
        end = x.getField("pos") + x.getField("len")
        apart = x.getField("pos") > s.getField("to")
        closed = F.concat(s.getField("done"), F.array(F.struct(s.getField("from").alias("from"), s.getField("to").alias("to"))))
        return F.struct(
            F.when(apart, closed).otherwise(s.getField("done")).alias("done"),
            F.when(apart, x.getField("pos")).otherwise(s.getField("from")).alias("from"),
            F.when(apart, end).otherwise(F.greatest(s.getField("to"), end)).alias("to"),
        )

    end = lambda s: F.concat(s.getField("done"), F.array(F.struct(s.getField("from").alias("from"), s.getField("to").alias("to"))))
    spans = places.select("key", F.aggregate("places", start, step, end).alias("spans"))
    spans = spans.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s.getField("to") - s.getField("from")))
    found = hits.select("key", "hash", "gram").distinct().join(grams.select("hash", "gram", "item"), ["hash", "gram"])
    items = found.groupBy("key").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    return spans.join(items, "key", "left")


def hit_keys(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = 10, max_broadcast_windows: int = MAX_BROADCAST_WINDOWS,
) -> DataFrame:
    """Keys of the documents with a hit, each once."""
    grams = benchmark_windows(benchmark, item_id, item_text, width)
    return occurrences(docs, grams, doc_id, text, max_broadcast_windows).select("key").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without contaminated documents, or with the hit spans cut out of their texts.

    Removing spans keeps the text before the first and after the last word of each span, in the
    original spelling; untouched documents keep their text byte for byte.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    rows = docs.select(F.struct("*").alias("row"), row_key(F.col(doc_id), F.col(text)).alias("key"))
    if remove == "documents":
        # Only the keys of hit documents are needed, and while they are few the texts need not move.
        keys = work_table(hit_keys(docs, benchmark, doc_id, text, **options), "benchmark-keys")
        return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, "key", "left_anti").select("row.*")
    report = decontamination_report(docs, benchmark, doc_id, text, **options)
    t = F.col(f"row.`{text}`")
    # Words and the stretches between them alternate; stretch i stands before word i.
    lower = ascii_lower(t)
    word_at = F.expr("transform(regexp_extract_all(low, '[^\\\\x00-\\\\x2F\\\\x3A-\\\\x60\\\\x7B-\\\\x7F]+', 0), x -> char_length(x))")
    gap_at = F.expr("transform(split(low, '[^\\\\x00-\\\\x2F\\\\x3A-\\\\x60\\\\x7B-\\\\x7F]+'), x -> char_length(x))")
    cut = rows.join(report.select("key", "spans"), "key", "left").withColumn("low", F.when(F.col("spans").isNotNull(), lower))
    cut = cut.withColumn("wl", word_at).withColumn("gl", gap_at)
    # Start of word i in characters: all words and stretches before it.
    lens = F.expr("slice(flatten(transform(arrays_zip(gl, wl), z -> array(coalesce(z.gl, 0), coalesce(z.wl, 0)))), 1, 2 * size(wl))")
    cut = cut.withColumn("lens", lens)
    kept = F.expr(
        "array_join(transform(sequence(0, size(spans)), j -> substring(txt,"
        " 1 + if(j = 0, 0, aggregate(slice(lens, 1, 2 * spans[j - 1].to), 0, (a, b) -> a + b)),"
        " if(j = size(spans), char_length(txt), aggregate(slice(lens, 1, 2 * spans[j].from + 1), 0, (a, b) -> a + b))"
        "   - if(j = 0, 0, aggregate(slice(lens, 1, 2 * spans[j - 1].to), 0, (a, b) -> a + b)))), '')"
    )
    cut = cut.withColumn("txt", t).withColumn("out", F.when(F.col("spans").isNull(), t).otherwise(kept))
    return cut.select(*[F.col("out").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op3_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's digest, one row per document."""
    report = decontamination_report(docs, benchmark)
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return rows.join(report, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
