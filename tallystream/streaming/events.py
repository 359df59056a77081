"""Event logs on a stream: duplicates, and waiting for references."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def stream_dedup(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Each event once; a repetition is recognised while it is at most ``delay`` late."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_await_join(
    facts: DataFrame,
    dims: DataFrame,
    on: Sequence[str],
    fact_ts: str,
    dim_ts: str,
    earlier: str,
    within: str,
    delay: str = "1 hour",
    how: str = "inner",
) -> DataFrame:
    """Facts with the row they refer to, which may be up to ``earlier`` older or up to
    ``within`` younger. With ``how='left_outer'`` a fact whose row never comes leaves with
    nulls after that time, so nothing waits for ever."""
    renamed = dims.withWatermark(dim_ts, delay).select(
        *[F.col(c).alias(f"__{c}") if c in on else F.col(c) for c in dims.columns]
    )
    match = (F.col(dim_ts) >= F.col(fact_ts) - F.expr(f"interval {earlier}")) & (
        F.col(dim_ts) <= F.col(fact_ts) + F.expr(f"interval {within}")
    )
    for c in on:
        match = match & (F.col(c) == F.col(f"__{c}"))
    return facts.withWatermark(fact_ts, delay).join(renamed, match, how).drop(*[f"__{c}" for c in on])
