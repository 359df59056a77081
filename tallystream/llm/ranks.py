"""Gapless numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tallystream.session import cut_lineage


def stored_with_parts(rows: DataFrame) -> DataFrame:
    """``rows`` written once, each with the number of the task that wrote it (``part``)."""
    return cut_lineage(rows.withColumn("part", F.spark_partition_id()))


def ranked(stored: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """Adds ``name``, gapless from 0 within ``keys``, without bringing a group into one task.

    Rows of ``stored_with_parts`` are numbered within (keys, part), which one task has held
    before; one row per (keys, part) carries the counts over to the next part.
    """
    keys = list(keys)
    counts = stored.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy(*keys).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(*keys, "part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    own = F.row_number().over(W.partitionBy(*keys, "part").orderBy(*order)) - 1
    return (
        stored.withColumn(name, own)
        .join(before, [*keys, "part"])
        .withColumn(name, (F.col(name) + F.col("__before")).cast("long"))
        .drop("__before", "part")
    )
