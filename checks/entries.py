"""All registered Spark queries."""

from __future__ import annotations

from checks import attribution, behavior, jobs, operators, parity
from checks.common import Query, query

GROUPS = (
    parity.PARITY, attribution.ATTRIBUTION, attribution.STAGING, behavior.METRIC_LAYER, behavior.TEMPLATES,
    behavior.QUESTIONS, jobs.EXPORT, jobs.REFRESH, operators.OPERATORS,
)


def all_queries() -> dict[str, Query]:
    return {name: query(build) for group in GROUPS for name, build in group.items()}
