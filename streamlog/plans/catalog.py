"""All registered queries."""

from __future__ import annotations

from streamlog.plans import q_commits, q_delivery, q_produce, q_sources, q_state, q_streams  # noqa: F401
from streamlog.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
