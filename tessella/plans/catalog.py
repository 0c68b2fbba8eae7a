"""All registered queries."""

from __future__ import annotations

# each module registers its queries
from tessella.plans import audits, dedup, formats, gates, geometry, incremental, inventory, joins, quotas, ranking, shapes  # noqa: F401
from tessella.plans.registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
