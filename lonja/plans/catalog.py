"""All registered queries."""

from __future__ import annotations

import importlib

from lonja.plans.registry import ORACLES, QUERIES, Query

_MODULES = ("queries_sources", "queries_rules", "queries_star", "queries_kpis", "queries_audit")


def _register() -> None:
    for module in _MODULES:
        importlib.import_module(f"lonja.plans.{module}")


def queries() -> dict[str, Query]:
    _register()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _register()
    return dict(ORACLES)
