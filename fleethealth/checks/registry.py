"""Registry of checked queries: name -> (Spark query, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleethealth.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def r5(x: str) -> str:
    return f"round_even({x}, 5)"


def quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)
