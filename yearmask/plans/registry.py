"""Every query over the given tables with its SQL twin. Modules of this package add theirs when they are imported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is there twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def load() -> None:
    from yearmask.plans import analytics, evidence, flagship, portfolio, reports, scans, singles, streams  # noqa: F401


load()
