"""All registered queries, in one place."""

from __future__ import annotations

from ledgerloom.plans import q_audit, q_clean, q_facts, q_files, q_resolve, q_rollup, q_serve  # noqa: F401
from ledgerloom.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
