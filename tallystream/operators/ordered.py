"""Order-dependent building blocks that do not put one hot key into one task.

Every function works per key in a given total order. While all keys are small the plan is
an ordinary window over the key. Once some key holds more than ``hot_rows`` rows, the rows
are cut along the order into slices (ranges of the whole order, stored with the rows), the
window runs inside (key, slice), and one small row per (key, slice) carries what the next
slice needs: a count, a sum, or the last row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystream.operators.sizing import null_safe_join
from tallystream.session import cut_lineage

HOT_ROWS = 4_000_000
SLICE = "__slice"


def _as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def slice_by_order(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    hot_rows: int = HOT_ROWS,
    min_slices: int = 1,
) -> tuple[DataFrame, bool]:
    """Add the slice column; the flag tells whether more than one slice is in use.

    Slices are ranges of the whole order, of any types, nulls and ties included (equal rows
    share one). They are stored with the rows, so a lost executor cannot change them, and
    what comes before is not run again.
    """
    keys, order = _as_list(keys), _as_list(order)
    sizes = df.groupBy(*keys).count() if keys else df.agg(F.count("*").alias("count"))
    largest, total = sizes.agg(F.max("count"), F.sum("count")).first()
    if not total or (largest <= hot_rows and min_slices <= 1):
        return df.withColumn(SLICE, F.lit(0)), False
    wanted = max(min_slices, math.ceil(total / hot_rows))
    dealt = df.repartitionByRange(wanted, *order).withColumn(SLICE, F.spark_partition_id())
    return cut_lineage(dealt), True


def _carry_sum(df: DataFrame, keys: list[str], amount: Column) -> DataFrame:
    """Per (key, slice): the total of ``amount`` over the key's earlier slices, null if there is none."""
    totals = df.groupBy(*keys, SLICE).agg(F.sum(amount).alias("__amount"))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, SLICE, F.sum("__amount").over(before).alias("__carry"))


def number_rows(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    name: str = "rn",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Dense numbers 0, 1, 2, ... per key in ``order`` (over all rows if ``keys`` is empty)."""
    keys, order = _as_list(keys), _as_list(order)
    min_slices = 1 if keys else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced, many = slice_by_order(df, keys, order, hot_rows, min_slices)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    if not many:
        inside = Window.partitionBy(*keys).orderBy(*order) if keys else inside
        return sliced.withColumn(name, F.row_number().over(inside).cast("long") - 1).drop(SLICE)
    offsets = _carry_sum(sliced, keys, F.lit(1))
    return (
        null_safe_join(sliced, offsets, [*keys, SLICE])
        .withColumn(name, F.coalesce("__carry", F.lit(0)) + F.row_number().over(inside) - 1)
        .drop("__carry", SLICE)
    )


def running_sum(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    amount: Column,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sum of ``amount`` from the key's first row up to and including the current row."""
    sliced, many = slice_by_order(df, keys, order, hot_rows)
    return running_in_slices(sliced, many, keys, order, amount, name).drop(SLICE)


def running_in_slices(
    sliced: DataFrame,
    many: bool,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    amount: Column,
    name: str,
) -> DataFrame:
    """``running_sum`` over rows that already carry slices."""
    keys, order = _as_list(keys), _as_list(order)
    so_far = (
        Window.partitionBy(*keys, *([SLICE] if many else []))
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    if not many:
        return sliced.withColumn(name, F.sum(amount).over(so_far))
    return (
        null_safe_join(sliced, _carry_sum(sliced, keys, amount), [*keys, SLICE])
        .withColumn(name, F.sum(amount).over(so_far))
        .withColumn(name, F.coalesce(F.col("__carry") + F.col(name), F.col(name), F.col("__carry")))
        .drop("__carry")
    )


def previous_values(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    values: Mapping[str, Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add, for each name, the value its expression had on the key's previous row."""
    sliced, many = slice_by_order(df, keys, order, hot_rows)
    return previous_in_slices(sliced, many, keys, order, values).drop(SLICE)


def previous_in_slices(
    sliced: DataFrame,
    many: bool,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    values: Mapping[str, Column],
) -> DataFrame:
    """``previous_values`` over rows that already carry slices."""
    keys, order = _as_list(keys), _as_list(order)
    packed = F.struct(*[expr.alias(name) for name, expr in values.items()])
    if not many:
        row = Window.partitionBy(*keys).orderBy(*order)
        out = sliced.withColumn("__prev", F.lag(packed).over(row))
    else:
        row = Window.partitionBy(*keys, SLICE).orderBy(*order)
        along = Window.partitionBy(*keys).orderBy(SLICE)
        tails = (
            sliced.groupBy(*keys, SLICE)
            .agg(F.max_by(packed, F.struct(*order)).alias("__tail"))
            .select(*keys, SLICE, F.lag("__tail").over(along).alias("__carried"))
        )
        out = (
            null_safe_join(sliced, tails, [*keys, SLICE])
            .withColumn("__first", F.row_number().over(row) == 1)
            .withColumn(
                "__prev", F.when(F.col("__first"), F.col("__carried")).otherwise(F.lag(packed).over(row))
            )
            .drop("__first", "__carried")
        )
    return out.withColumns({name: F.col(f"__prev.{name}") for name in values}).drop("__prev")


def rolling(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    n: int,
    aggregates: Mapping[str, Column],
    hot_rows: int = HOT_ROWS,
    rn: str | None = None,
) -> DataFrame:
    """Aggregates over the last ``n`` rows of the key at each row.

    For hot keys rows are numbered and cut into blocks of ``hot_rows``; each block also
    receives the ``n - 1`` rows before it, so every frame is complete inside its block.
    """
    if n < 1:
        raise ValueError("a frame needs at least one row")
    keys, order = _as_list(keys), _as_list(order)
    if rn is None:
        largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if largest <= hot_rows:
            frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - n, 0)
            return df.withColumns({name: expr.over(frame) for name, expr in aggregates.items()})
        df, position = number_rows(df, keys, order, "__rn", hot_rows), "__rn"
    else:
        position = rn
    block_rows = max(hot_rows, n)
    home = F.floor(F.col(position) / block_rows)
    last = F.floor((F.col(position) + (n - 1)) / block_rows)
    frame = Window.partitionBy(*keys, "__block").orderBy(position).rowsBetween(1 - n, 0)
    out = (
        df.withColumn("__home", home)
        .withColumn("__block", F.explode(F.sequence(home, last)))
        .withColumns({name: expr.over(frame) for name, expr in aggregates.items()})
        .filter("__block = __home")
        .drop("__home", "__block")
    )
    return out.drop("__rn") if rn is None else out


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """Last row per key. An aggregate, so each task sends one row per key, hot or not."""
    return _extreme_per_key(df, keys, order, F.max_by)


def first_per_key(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """First row per key."""
    return _extreme_per_key(df, keys, order, F.min_by)


def _extreme_per_key(df, keys, order, pick) -> DataFrame:
    keys, order = _as_list(keys), _as_list(order)
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*rest), F.struct(*order)).alias("__row"))
        .select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])
    )
