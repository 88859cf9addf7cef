"""All registered queries."""

from __future__ import annotations

from risklake.plans import queries_decisions, queries_features, queries_streaming  # noqa: F401  (they register)
from risklake.plans.registry import CHECKS, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def checks() -> dict[str, str]:
    return dict(CHECKS)
