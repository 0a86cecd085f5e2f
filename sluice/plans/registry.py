"""Registered queries: a callable (spark, sf_dir) -> DataFrame by key, and its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        assert key not in QUERIES, key
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return keep
