"""Registered queries against their SQL, and the pipeline."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import connect, duck_rows, spark_rows, type_differences
from tests.conftest import SF
from trailmark.llm.queries import QUERIES
from trailmark.llm.sql import oracle_sql


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", oracle_sql())
def test_matches_oracle(spark, name):
    duck, df = connect(SF), QUERIES[name](spark, SF)
    assert spark_rows(df) == duck_rows(duck, oracle_sql()[name])
    assert not type_differences(df, duck, oracle_sql()[name])


def test_pipeline(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns, name
        if name != "mixing":
            assert kept.exceptAll(before).count() == 0, name
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert last.count() == kept.count()
    assert last.select("shard").distinct().count() == 8


def test_pipeline_of_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF).cache()
            assert docs.columns == odd.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
