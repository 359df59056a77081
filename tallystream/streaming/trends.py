"""Group trends on a stream. All results come out once, when the watermark closes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallystream.functions.scalars import percent_change, window_end


def _daily(df: DataFrame, ts: str, group: str, value: str, delay: str) -> DataFrame:
    return (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("w"), F.col(group).alias("grp"))
        .agg(F.avg(value).alias("daily_avg"))
    )


def _sliding(daily: DataFrame, size: str, slide: str) -> DataFrame:
    # The second window has to be built on window_time, which carries the watermark on.
    at = F.window_time("w")
    return (
        daily.select("grp", "daily_avg", at.alias("at"))
        .groupBy("grp", F.window("at", size, slide).alias("w"))
        .agg(
            F.avg("daily_avg").alias("moving_avg"),
            F.min_by("daily_avg", "at").alias("first_avg"),
            F.max_by("daily_avg", "at").alias("last_avg"),
        )
        .withColumn("pct", percent_change("first_avg", "last_avg"))
    )


def _label():
    """The batch form labels a window one day later, as its days carry their end as date."""
    return window_end("w") + F.expr("interval 1 day")


def stream_daily_avg(df: DataFrame, ts: str, group: str, value: str, delay: str = "1 day") -> DataFrame:
    """(date, grp, daily_avg); rows more than ``delay`` behind the newest one are dropped."""
    return _daily(df, ts, group, value, delay).select(window_end("w").alias("date"), "grp", "daily_avg")


def stream_moving_avg(
    df: DataFrame, ts: str, group: str, value: str, delay: str = "1 day", size: str = "7 days", slide: str = "1 day"
) -> DataFrame:
    """(date, grp, moving_avg, first_avg, last_avg, pct) as in the batch form."""
    return _sliding(_daily(df, ts, group, value, delay), size, slide).select(
        _label().alias("date"), "grp", "moving_avg", "first_avg", "last_avg", "pct"
    )


def stream_top_group(
    df: DataFrame, ts: str, group: str, value: str, delay: str = "1 day", size: str = "7 days", slide: str = "1 day"
) -> DataFrame:
    """(date, top_group, highest_increase)."""
    return (
        _sliding(_daily(df, ts, group, value, delay), size, slide)
        .groupBy("w")
        .agg(F.max(F.struct("pct", "grp")).alias("top"))
        .select(
            _label().alias("date"),
            F.col("top.grp").alias("top_group"),
            F.col("top.pct").alias("highest_increase"),
        )
    )
