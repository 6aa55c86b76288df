"""Registered queries: a Spark builder and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None, name: str | None = None):
    def keep(fn: Builder) -> Builder:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return keep
