"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trailmark.config import prepare_session
from trailmark.llm import decontaminate, imatch, language, licenses, lm, mixing, neardup, periodic, pii, quality, secrets, sharding, whitening
from trailmark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def over(digest: Callable[..., DataFrame], *tables: str) -> Query:
    """A query that applies an operator's digest to whole tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_session(spark)
        return digest(*(table(spark, sf_dir, t) for t in tables))

    run.__doc__ = digest.__doc__
    return run


QUERIES: dict[str, Query] = {
    "op1_context_mixing": over(lm.op1_query, "documents"),
    "op2_secret_scan": over(secrets.op2_query, "documents"),
    "op3_benchmark_decontamination": over(decontaminate.op3_query, "documents", "benchmark"),
    "op4_language_id": over(language.op4_query, "documents"),
    "op5_pii_anchors": over(pii.op5_query, "documents"),
    "op6_sampled_splitter_shards": over(sharding.op6_query, "documents"),
    "op7_license_scan": over(licenses.op7_query, "documents"),
    "op8_probminhash_classes": over(neardup.op8_query, "documents"),
    "op9_budget_mix": over(mixing.op9_query, "documents"),
    "op10_imatch_fingerprints": over(imatch.op10_query, "documents"),
    "op11_periodic_runs": over(periodic.op11_query, "documents"),
    "op12_jacobi_davidson_whitening": over(whitening.op12_query, "embeddings"),
    "op13_fourier_quality": over(quality.op13_query, "documents", "labels"),
}
