"""Join helpers whose strategy depends on a measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if a bounded count proves it is small.

    The count stops at ``max_rows + 1`` rows. A larger table comes back unmarked and the
    join falls to the shuffle strategies (with adaptive skew handling).
    """
    seen = df.limit(max_rows + 1).count()
    return F.broadcast(df) if seen <= max_rows else df


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match null keys; the key columns appear once."""
    renamed = right.select(
        *[F.col(c).alias(f"__{c}") if c in on else F.col(c) for c in right.columns]
    )
    condition = F.lit(True)
    for c in on:
        condition = condition & left[c].eqNullSafe(renamed[f"__{c}"])
    return left.join(renamed, condition, how).drop(*[f"__{c}" for c in on])


CROWD_ROWS = 2_000


def spread_crowds(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_id: str, crowd_rows: int = CROWD_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``on`` with a salt, so that a crowded key uses many tasks.

    A key with more than ``crowd_rows`` rows on the right is cut into parts: a left row goes
    to one part by a hash of ``left_id``, a right row to all of them. Join on
    ``[*on, "salt"]``; the pairs are the same as without the salt.
    """
    crowded = (
        right.groupBy(*on)
        .count()
        .filter(F.col("count") > crowd_rows)
        .select(*on, F.ceil(F.col("count") / crowd_rows).cast("int").alias("__parts"))
    )
    parts = F.coalesce("__parts", F.lit(1))
    salted = left.join(crowded, list(on), "left").withColumn("salt", F.pmod(F.xxhash64(left_id), parts).cast("int"))
    copied = right.join(crowded, list(on), "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return salted.drop("__parts"), copied.drop("__parts")
