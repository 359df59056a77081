"""Queries over the driver tables, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def six(value: Column | str) -> Column:
    """Six places. The nudge keeps exact halves (sums over a power of two) off the rounding
    edge, where the order of a floating-point sum would decide; the SQL does the same."""
    return F.round((F.col(value) if isinstance(value, str) else value) + 1e-9, 6)


def load_all() -> None:
    from tallystream.plans import contacts, ledger, proximity, sensors, streams, trends  # noqa: F401
