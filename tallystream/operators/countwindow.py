"""Count-based sliding windows over keyed readings.

Window ``k`` of a key holds its readings ``k * slide`` to ``k * slide + size - 1`` in order;
only full windows come out. Readings are numbered per key (``ordered.number_rows``), then
either sent to the few windows they belong to and aggregated, or, where windows overlap
many times, evaluated as a rolling frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallystream.operators.ordered import HOT_ROWS, number_rows, rolling
from tallystream.operators.sizing import broadcast_if_small

# Fixed names of the window functions.
AGGREGATES = {"average": F.avg, "sum": F.sum, "max": F.max, "min": F.min}

MAX_COPIES = 8  # above this overlap a rolling frame is cheaper than copies of each reading


def named_aggregate(name: str) -> Callable[[Column | str], Column]:
    """Aggregate for a name in any case; 0.0 over no rows; unknown names are an error."""
    try:
        fn = AGGREGATES[name.lower()]
    except KeyError:
        raise ValueError(f"unknown aggregate function {name!r}") from None
    return lambda c: F.coalesce(fn(c), F.lit(0.0))


def check_window(size: int, slide: int) -> None:
    if slide < 1:
        raise ValueError("the slide must be at least 1")
    if slide > size:
        raise ValueError("the slide cannot be greater than the window size")


def _window_ids(rn: Column, size, slide) -> Column:
    """All windows of a reading: from the first one still open at it to the last one begun."""
    lowest = F.greatest(F.lit(0), F.ceil((rn - size + 1) / slide)).cast("long")
    highest = F.floor(rn / slide).cast("long")
    return F.sequence(lowest, highest)


def _windows(numbered: DataFrame, keys: list[str], rn: Column, size, slide) -> DataFrame:
    # With slide > 1 a reading can fall behind every window only if slide > size, which is
    # refused, so the sequence never runs backwards.
    return numbered.withColumn("k", F.explode(_window_ids(rn, size, slide)))


def count_window(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    size: int,
    slide: int,
    aggs: Sequence[str] = ("average",),
    ts: str | None = None,
    lanes: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(keys, [lane], k, one column per aggregate, [ts of the last reading]).

    With ``lanes`` the readings of a key are dealt round-robin to that many lanes and every
    lane has windows of its own.
    """
    check_window(size, slide)
    keys = [keys] if isinstance(keys, str) else list(keys)
    fns = {name.lower(): named_aggregate(name) for name in aggs}
    numbered = number_rows(df.filter(F.col(value).isNotNull()), keys, order, "__n", hot_rows)
    groups, rn = keys, F.col("__n")
    if lanes:
        numbered = numbered.withColumn("lane", (rn % lanes).cast("int"))
        numbered = numbered.withColumn("__n", F.floor(rn / lanes))
        groups = [*keys, "lane"]
    columns = {name: fn(value) for name, fn in fns.items()}
    if -(-size // slide) > MAX_COPIES:
        # every frame kept below is full, so the empty-input default cannot apply
        columns = {name: AGGREGATES[name](value) for name in columns}
        if ts:
            columns["ts"] = F.last(ts)
        framed = rolling(numbered, groups, "__n", size, columns, hot_rows, rn="__n")
        closing = (rn >= size - 1) & ((rn - (size - 1)) % slide == 0)
        return framed.filter(closing).select(
            *groups, ((rn - (size - 1)) / slide).cast("long").alias("k"), *columns
        )
    aggregated = [c.alias(n) for n, c in columns.items()]
    if ts:
        aggregated.append(F.max_by(ts, "__n").alias("ts"))
    return (
        _windows(numbered, groups, rn, size, slide)
        .groupBy(*groups, "k")
        .agg(F.count("*").alias("__filled"), *aggregated)
        .filter(F.col("__filled") == size)
        .drop("__filled")
    )


def lane_window(df, keys, order, value, size, slide, n: int = 4, aggs=("average",), **kw) -> DataFrame:
    return count_window(df, keys, order, value, size, slide, aggs, lanes=n, **kw)


def check_config(config: DataFrame) -> None:
    """Refuse a configuration with bad sizes or unknown functions before any data is read."""
    known = F.lower("fn").isin(*AGGREGATES)
    wrong = config.filter(
        ~known | F.col("fn").isNull() | (F.col("slide") < 1) | (F.col("slide") > F.col("window_size"))
    ).first()
    if wrong is not None:
        raise ValueError(f"bad window configuration: {wrong.asDict()}")


def route(df: DataFrame, config: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """Readings with a configured key (with their configuration) and all other readings.

    Keys match in any case.
    """
    small = broadcast_if_small(config.withColumn("__k", F.lower("key")).drop("key"))
    tagged = df.withColumn("__k", F.lower(key))
    routed = tagged.join(small, "__k").drop("__k")
    unrouted = tagged.join(small.select("__k"), "__k", "left_anti").drop("__k")
    return routed, unrouted


def count_window_by_config(
    df: DataFrame, config: DataFrame, key: str, order: str, value: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Count windows whose size, slide and function come from ``config``.

    ``config``: key, window_size, slide, fn. Readings of other keys are left out
    (see ``route``).
    """
    check_config(config)
    routed, _ = route(df.filter(F.col(value).isNotNull()), config, key)
    numbered = number_rows(routed, key, order, "__n", hot_rows)
    size, slide = F.col("window_size"), F.col("slide")
    wanted = F.lower(F.first("fn"))
    result = F.lit(None).cast("double")
    for name in AGGREGATES:
        result = F.when(wanted == name, named_aggregate(name)(value)).otherwise(result)
    return (
        _windows(numbered, [key], F.col("__n"), size, slide)
        .groupBy(key, "k")
        .agg(
            F.count("*").alias("__filled"),
            F.first("window_size").alias("__size"),
            wanted.alias("fn"),
            result.alias("value"),
        )
        .filter("__filled = __size")
        .select(key, "k", "fn", "value")
    )


def count_window_apply(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    size: int,
    slide: int,
    fn: Callable[[list[float]], float],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Count windows with a user function from the ordered list of values to one number.

    A window never holds more than ``size`` values, and many windows travel to Python in
    one Arrow batch.
    """
    check_window(size, slide)
    keys = [keys] if isinstance(keys, str) else list(keys)
    numbered = number_rows(df.filter(F.col(value).isNotNull()), keys, order, "__n", hot_rows)

    @F.pandas_udf("double")
    def apply(windows: pd.Series) -> pd.Series:
        return windows.map(lambda values: float(fn([float(v) for v in values])))

    filled = (
        _windows(numbered, keys, F.col("__n"), size, slide)
        .groupBy(*keys, "k")
        .agg(F.sort_array(F.collect_list(F.struct("__n", F.col(value).alias("v")))).alias("__rows"))
        .filter(F.size("__rows") == size)
    )
    return filled.select(*keys, "k", apply(F.col("__rows.v")).alias("value"))
