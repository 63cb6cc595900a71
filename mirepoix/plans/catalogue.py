"""All registered queries."""

from __future__ import annotations

from mirepoix.plans import (  # noqa: F401
    cleaning_queries,
    curation_queries,
    exploration_queries,
    report_queries,
    scoring_queries,
    unit_queries,
)
from mirepoix.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
