"""Filters on the kind of a message."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallystream.functions.scalars import DATA_OP


def data_ops(df: DataFrame) -> DataFrame:
    """Data messages only; fault messages never reach a window."""
    return df.filter(F.col("op") == DATA_OP)
