"""Configuration, registered queries and batch jobs."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("queries_grid", "queries_time", "queries_checks", "queries_more")


def load_queries():
    """All registered queries and their SQL, as two dictionaries."""
    for name in _MODULES:
        import_module(f"orbgrid.plans.{name}")
    from orbgrid.plans.registry import QUERIES, SQL

    return dict(QUERIES), dict(SQL)
