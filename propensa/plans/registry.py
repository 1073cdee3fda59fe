"""Registered queries: one Spark builder per operator of the proposal
(README, P1-P26) and, where SQL can say it, one DuckDB oracle statement.

Every builder takes ``(spark, sf_dir)`` and reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}


def register(name: str):
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        return fn
    return deco


def queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    from propensa.plans.oracle import ORACLE
    return {k: v for k, v in ORACLE.items() if k in _QUERIES}


def _load() -> None:
    # importing the plan modules registers their queries
    from propensa.plans import batch, relations, streams  # noqa: F401
