"""All registered queries; importing a query module registers what it holds."""

from __future__ import annotations

from ledgerlake.plans import (  # noqa: F401
    expression_queries,
    ledger_queries,
    metric_queries,
    source_queries,
)
from ledgerlake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
