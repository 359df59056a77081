"""Count windows on a stream, with the open window of each key kept as state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallystream.operators.countwindow import check_config, check_window, named_aggregate
from tallystream.operators.sizing import broadcast_if_small

STATE = "pending array<double>, next_k bigint"
BLOCK_READINGS = 4_096
REDUCE = {"average": np.mean, "sum": np.sum, "max": np.max, "min": np.min}


def _advance(state: GroupState, values: np.ndarray, size: int, slide: int) -> tuple[int, np.ndarray]:
    """Add new values to the state; returns the number of the first full window and all
    full windows as rows of a matrix."""
    pending, first_k = state.get if state.exists else ([], 0)
    held = np.concatenate([np.asarray(pending, dtype=float), values])
    full = 0 if len(held) < size else (len(held) - size) // slide + 1
    windows = np.lib.stride_tricks.sliding_window_view(held, size)[::slide][:full] if full else np.empty((0, size))
    state.update(([float(v) for v in held[full * slide :]], int(first_k) + full))
    return int(first_k), windows


def _closing(times: pd.Series, held: int, size: int, slide: int, full: int) -> list:
    """Time of the reading that filled each window; it is always among the new ones."""
    return [times.iloc[size - 1 + i * slide - held] for i in range(full)]


def _in_blocks(rows: DataFrame, keys: list[str], block_readings: int) -> DataFrame:
    """(keys, k, value, ts, fn) of the windows of readings (keys, n, v, t, size, slide, fn) that are numbered
    without gaps, from 0 in each key.

    Windows are put into blocks, which overlap by size - 1 readings. A block is a state of its
    own, so a busy key uses many tasks; a window leaves as soon as its readings are there,
    in whatever order they come. Of a number that comes twice the first reading counts.
    """
    per_block = F.ceil(F.greatest(F.lit(block_readings), F.col("size")) / F.col("slide")).cast("long")
    lowest = F.greatest(F.lit(0), F.ceil((F.col("n") - F.col("size") + 1) / F.col("slide"))).cast("long")
    highest = F.floor(F.col("n") / F.col("slide")).cast("long")
    blocks = F.sequence(F.floor(lowest / per_block), F.floor(highest / per_block))  # one or two
    dealt = rows.withColumn("per_block", per_block).withColumn("block", F.explode(blocks))

    def update(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches))  # at most the readings of a block
        size, slide, count, fn = (rows[c].iloc[0] for c in ("size", "slide", "per_block", "fn"))
        left = np.arange(group[-1] * count, (group[-1] + 1) * count)
        n, v, t = rows["n"].to_numpy(), rows["v"].to_numpy(dtype=float), rows["t"].to_numpy().astype("datetime64[us]").astype(np.int64)
        if state.exists:
            held = [np.asarray(x) for x in state.get]
            n, v, t = (np.concatenate([a.astype(b.dtype), b]) for a, b in zip(held, (n, v, t)))
            left = held[3].astype(np.int64)
        n, place = np.unique(n, return_index=True)  # what came first stays
        v, t = v[place], t[place]
        start = left * slide
        first = np.searchsorted(n, start)
        last = first + size - 1
        inside = last < len(n)
        full = inside.copy()
        full[inside] = (n[first[inside]] == start[inside]) & (n[last[inside]] == start[inside] + size - 1)
        open_ = left[~full]
        if len(open_):
            needed = n >= open_.min() * slide
            state.update((n[needed].tolist(), v[needed].tolist(), t[needed].tolist(), open_.tolist()))
        elif state.exists:
            state.remove()
        if full.any():
            windows = v[first[full][:, None] + np.arange(size)]
            out = {name: [part] * len(windows) for name, part in zip(keys, group)}
            out |= {"k": left[full], "value": REDUCE[fn](windows, axis=1), "ts": t[last[full]].astype("datetime64[us]"), "fn": fn}
            yield pd.DataFrame(out)

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys)
    return dealt.groupBy(*keys, "block").applyInPandasWithState(
        update,
        f"{kinds}, k bigint, value double, ts timestamp, fn string",
        "n array<bigint>, v array<double>, t array<bigint>, open array<bigint>",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def stream_count_window(
    df: DataFrame, key: str, order: str, value: str, size: int, slide: int, agg: str = "average",
    ts: str = "ts", lanes: int | None = None, dense: bool = False, block_readings: int = BLOCK_READINGS,
) -> DataFrame:
    """(key, [lane], k, value, ts) for every window that fills up.

    Readings are taken in ``order`` inside a micro-batch and in order of arrival across
    micro-batches. A micro-batch of one key (and lane) is handled by one task, so bound it
    at the source (``flush_options``); ``lanes`` deals the readings of a busy key to
    independent windows by their number in ``order``, which must be dense per key then.

    With ``dense`` the source numbers the readings that have a value: ``order`` is gapless from 0
    in each key. Readings may then come in any order, and a busy key is spread over blocks
    of ``block_readings``, however large a micro-batch is.
    """
    check_window(size, slide)
    named_aggregate(agg)
    if dense:
        n, keys = F.col(order), [key, "lane"] if lanes else [key]
        rows = df.filter(F.col(value).isNotNull())
        if lanes:
            rows, n = rows.withColumn("lane", (F.col(order) % lanes).cast("int")), F.floor(F.col(order) / lanes)
        rows = rows.select(
            *keys, n.cast("long").alias("n"), F.col(value).alias("v"), F.col(ts).alias("t"),
            F.lit(size).alias("size"), F.lit(slide).alias("slide"), F.lit(agg.lower()).alias("fn"),
        )
        return _in_blocks(rows, keys, block_readings).drop("fn")
    reduce = REDUCE[agg.lower()]
    keys = [key, "lane"] if lanes else [key]

    def update(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("o", kind="stable")
        held = len(state.get[0]) if state.exists else 0
        first_k, windows = _advance(state, rows["v"].to_numpy(dtype=float), size, slide)
        n = len(windows)
        if n == 0:
            return
        out = {name: [part] * n for name, part in zip(keys, group)}
        out["k"] = range(first_k, first_k + n)
        out["value"] = reduce(windows, axis=1)
        out["ts"] = _closing(rows["t"], held, size, slide, n)
        yield pd.DataFrame(out)

    rows = df.filter(F.col(value).isNotNull())
    if lanes:
        rows = rows.withColumn("lane", (F.col(order) % lanes).cast("int"))
    rows = rows.select(*keys, F.col(order).alias("o"), F.col(value).alias("v"), F.col(ts).alias("t"))
    lane = "lane int, " if lanes else ""
    return rows.groupBy(*keys).applyInPandasWithState(
        update,
        f"{key} string, {lane}k bigint, value double, ts timestamp",
        STATE,
        "append",
        GroupStateTimeout.NoTimeout,
    )


def stream_count_window_by_config(
    df: DataFrame, config: DataFrame, key: str, order: str, value: str, ts: str = "ts", dense: bool = False,
    block_readings: int = BLOCK_READINGS,
) -> DataFrame:
    """(key, k, fn, value) with size, slide and function of each key from a static table; ``dense`` as above."""
    check_config(config)
    settings = broadcast_if_small(
        config.select(F.lower("key").alias("__k"), "window_size", "slide", F.lower("fn").alias("fn"))
    )

    if dense:
        rows = df.filter(F.col(value).isNotNull()).withColumn("__k", F.lower(key)).join(settings, "__k")
        rows = rows.select(
            F.col(key).alias("key"), F.col(order).cast("long").alias("n"), F.col(value).alias("v"), F.col(ts).alias("t"),
            F.col("window_size").alias("size"), "slide", "fn",
        )
        return _in_blocks(rows, ["key"], block_readings).select("key", "k", "fn", "value")

    def update(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("o", kind="stable")
        size, slide, fn = int(rows["window_size"].iloc[0]), int(rows["slide"].iloc[0]), rows["fn"].iloc[0]
        first_k, windows = _advance(state, rows["v"].to_numpy(dtype=float), size, slide)
        n = len(windows)
        if n:
            yield pd.DataFrame(
                {"key": [group[0]] * n, "k": range(first_k, first_k + n), "fn": [fn] * n,
                 "value": REDUCE[fn](windows, axis=1)}
            )

    rows = (
        df.filter(F.col(value).isNotNull())
        .withColumn("__k", F.lower(key))
        .join(settings, "__k")
        .select(F.col(key).alias("key"), F.col(order).alias("o"), F.col(value).alias("v"), "window_size", "slide", "fn")
    )
    return rows.groupBy("key").applyInPandasWithState(
        update, "key string, k bigint, fn string, value double", STATE, "append", GroupStateTimeout.NoTimeout
    )
