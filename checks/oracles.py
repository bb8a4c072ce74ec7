"""Oracle SQL per registered query, for DuckDB over the same Parquet tables."""

from __future__ import annotations

from checks import sql_attribution, sql_behavior, sql_jobs


def all_oracles() -> dict[str, str]:
    return {
        **sql_attribution.parity(), **sql_attribution.attribution(), **sql_attribution.staging(),
        **sql_behavior.metric_layer(), **sql_behavior.templates(), **sql_behavior.questions(),
        **sql_behavior.operators(), **sql_jobs.exports(), **sql_jobs.refresh(),
    }
