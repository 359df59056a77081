"""Daily averages per group, moving averages over them, and the top group per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallystream.functions.scalars import percent_change, window_end


def daily_average(df: DataFrame, ts: str, group: str, value: str) -> DataFrame:
    """Average of ``value`` per group and calendar day, labelled with the end of the day."""
    return (
        df.groupBy(F.window(ts, "1 day").alias("w"), F.col(group).alias("grp"))
        .agg(F.avg(value).alias("daily_avg"))
        .select(window_end("w").alias("date"), "grp", "daily_avg")
    )


def daily_average_of_members(
    df: DataFrame, ts: str, member: str, value: str, membership: DataFrame
) -> DataFrame:
    """``daily_average`` where ``membership`` (member, grp) names the group of each row.

    Rows are summed per member and day before the join, so the join sees one row per member
    and day however many readings a busy member sends. Nulls in ``value`` are not counted.
    """
    per_member = (
        df.groupBy(F.window(ts, "1 day").alias("w"), F.col(member).alias("member"))
        .agg(F.sum(value).alias("total"), F.count(value).alias("n"))
        .select(window_end("w").alias("date"), "member", "total", "n")
    )
    return (
        per_member.join(membership, "member")
        .groupBy("date", "grp")
        .agg(F.try_divide(F.sum("total"), F.sum("n")).alias("daily_avg"))
    )


def trend(daily: DataFrame, size: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Moving average, first and last daily value and percent increase per sliding window.

    First and last follow the date, not the arrival of rows.
    """
    return (
        daily.groupBy("grp", F.window("date", size, slide).alias("w"))
        .agg(
            F.avg("daily_avg").alias("moving_avg"),
            F.min_by("daily_avg", "date").alias("first_avg"),
            F.max_by("daily_avg", "date").alias("last_avg"),
        )
        .select(
            window_end("w").alias("date"),
            "grp",
            "moving_avg",
            "first_avg",
            "last_avg",
            percent_change("first_avg", "last_avg").alias("pct"),
        )
    )


def moving_average(daily: DataFrame, size: str = "7 days", slide: str = "1 day") -> DataFrame:
    return trend(daily, size, slide).select("date", "grp", "moving_avg")


def top_increase(trends: DataFrame) -> DataFrame:
    """Group with the highest increase per date; ties go to the greatest name, null is lowest."""
    return (
        trends.groupBy("date")
        .agg(F.max(F.struct("pct", "grp")).alias("top"))
        .select("date", F.col("top.grp").alias("top_group"), F.col("top.pct").alias("highest_increase"))
    )
