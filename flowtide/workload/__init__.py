"""Registered queries over the benchmark tables and their SQL oracles."""

from __future__ import annotations

from importlib import import_module

from flowtide.workload.registry import QUERIES, Query

_MODULES = ("positions", "networks", "dashboards", "ingestion")


def all_queries() -> dict[str, Query]:
    for module in _MODULES:
        import_module(f"flowtide.workload.{module}")
    return QUERIES
