"""License scans by diagonal voting.

Templates are short phrases and longer notices.  All rolling word ``K``-gram hashes of a document are
joined to the templates' gram positions; a match votes for the diagonal (document position minus
template position).  Votes are counted per diagonal, neighbouring diagonals are merged (words put in
or left out shift the diagonal), and each merged run is verified by the share of the template's
grams it covers, every gram having been compared by its words and not by its hash alone.

The template side is a constant of this module, so broadcasting it is bounded.

Defined cases: null or empty texts have no words, no places and score 0; repeated rows each get the
same result; a template found several times is one label; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.common import row_key, words

K = 2  # the shortest phrase has two words

# Phrases of the contract and their labels; a place needs every word.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices of the method's own; a label needs MIN_SHARE of the notice's grams on near diagonals.
NOTICES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-notice": (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at"
    ),
    "mit": "released under the mit license",
    "mit-notice": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction"
    ),
    "bsd-notice": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met"
    ),
    "gpl-3": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation"
    ),
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under the creative commons attribution sharealike license",
    "warranty": "the software is provided as is without warranty of any kind express or implied",
}
MIN_SHARE = 0.75
MERGE_WITHIN = 2


def templates() -> list[tuple[str, str, bool, list[str]]]:
    """(template, label, exact, words)."""
    exact = [(p, label, True, p.split()) for p, label in PHRASES.items()]
    return exact + [(f"notice {label}", label, False, t.split()) for label, t in NOTICES.items()]


def template_grams(spark: SparkSession) -> DataFrame:
    rows = [(t, label, exact, len(w) - K + 1, i, " ".join(w[i:i + K]))
            for t, label, exact, w in templates() for i in range(len(w) - K + 1)]
    grams = spark.createDataFrame(rows, "template string, label string, exact boolean, grams int, at int, known string")
    return grams.withColumn("hash", F.xxhash64("known"))


def _grams(tokens: Column) -> Column:
    n = F.size(tokens)
    pairs = F.transform(F.sequence(F.lit(0), n - K), lambda i: F.concat_ws(" ", F.get(tokens, i), F.get(tokens, i + 1)))
    return F.when(n >= K, pairs).otherwise(F.array().cast("array<string>"))


def diagonals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Votes: (key, template, label, exact, grams, diagonal, seen), ``seen`` being the template positions."""
    keyed = docs.select(row_key(F.col(doc_id), F.col(text)).alias("key"), words(F.col(text)).alias("w"))
    grams = keyed.select("key", F.posexplode(_grams(F.col("w"))).alias("pos", "gram")).withColumn("hash", F.xxhash64("gram"))
    votes = grams.join(F.broadcast(template_grams(docs.sparkSession)), "hash").filter(F.col("gram") == F.col("known"))
    votes = votes.withColumn("diagonal", F.col("pos") - F.col("at"))
    return votes.groupBy("key", "template", "label", "exact", "grams", "diagonal").agg(F.collect_set("at").alias("seen"))


def license_places(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of near diagonals: (key, template, label, exact, first, last, share).

    A phrase's diagonals stay apart, since each is a place of its own.
    """
    by = W.partitionBy("key", "template").orderBy("diagonal")
    near = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) <= MERGE_WITHIN, F.lit(False)) & ~F.col("exact")
    runs = diagonals(docs, doc_id, text).withColumn("opens", F.when(near, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("opens").over(by))
    merged = runs.groupBy("key", "template", "label", "exact", "grams", "run").agg(
        F.min("diagonal").alias("first"), F.max("diagonal").alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("covered"),
    )
    return merged.select("key", "template", "label", "exact", "first", "last", (F.col("covered") / F.col("grams")).alias("share"))


def license_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document key with any vote: phrase places, labels and the best share."""
    place = F.col("exact") & (F.col("share") == 1.0)
    found = F.when(F.col("exact"), F.col("share") == 1.0).otherwise(F.col("share") >= MIN_SHARE)
    return license_places(docs, doc_id, text).groupBy("key").agg(
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("first"))).cast("bigint").alias("first_word"),
        F.max(F.when(place, F.col("first"))).cast("bigint").alias("last_word"),
        F.array_sort(F.collect_set(F.when(place, F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set(F.when(found, F.col("label")))).alias("labels"),
        F.max("share").alias("score"),
    )


def op7_query(docs: DataFrame) -> DataFrame:
    """The contract's digest, one row per document."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    none = F.array().cast("array<string>")
    return rows.join(license_report(docs), "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        F.array_join(F.coalesce("base_labels", none), ",").alias("base_labels"),
        F.array_join(F.coalesce("labels", none), ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
