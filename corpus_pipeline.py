"""A training corpus from raw documents, in five stages.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read again as the next one's docs.

* language: documents whose language cannot be told, or that fit no learned language, go.
* near_duplicates: one document of every class of copies and near copies stays.
* decontamination: documents that hold a benchmark passage go.
* mixing: sources are brought to their target weights; documents are repeated or left out.
* sharding: every record gets a shard of about equal bytes and a slot in it.

All but the last return the columns of ``docs`` unchanged, extra ones included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.config import prepare_session, work_table
from trailmark.llm import decontaminate, language, mixing, neardup, sharding
from trailmark.llm.common import table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that language identification does not reject; models are learned from the rows' own labels."""
    prepare_session(spark)
    return language.identify(docs, F.lit(True)).filter(~F.col("found.rejected")).select("row.*")


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return neardup.drop_near_duplicates(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return mixing.mixed_documents(docs)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return sharding.op6_query(docs)


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_class),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix_sources),
    ("sharding", into_shards),
]

# Learned models and similarity classes have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepare_session(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work_table(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
