"""Group trends over events, with the nation of the user as the group."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystream.operators import trends as op
from tallystream.plans.registry import query, six
from tallystream.plans.tables import membership, table

DAILY_SQL = """
with b as (select ts, n_name as grp, value from events join customer on user_id = c_custkey
           join nation on c_nationkey = n_nationkey),
 d as (select date_trunc('day', ts)::timestamp + interval 1 day as date, grp, avg(value) as a from b group by 1, 2),
 x as (select d.date + to_days(k::int) as e, d.date as dd, grp, a from d, range(0, 7) r(k)),
 m as (select e + interval 1 day as date, grp, avg(a) as m, arg_min(a, dd) as f, arg_max(a, dd) as l,
       (arg_max(a, dd) - arg_min(a, dd)) / nullif(arg_min(a, dd), 0) * 100 as pct from x group by 1, 2)
"""


def daily(spark, d):
    return op.daily_average_of_members(table(spark, d, "events"), "ts", "user_id", "value", membership(spark, d))


def _trend(spark, d):
    return op.trend(daily(spark, d))


@query(
    "daily_group_avg",
    DAILY_SQL + "select date::timestamp as date, grp, round(a + 1e-9, 6) as daily_avg from d",
)
def daily_group_avg(spark, d):
    return daily(spark, d).select("date", "grp", six("daily_avg").alias("daily_avg"))


@query(
    "daily_group_avg_direct",
    """select date_trunc('day', ts)::timestamp + interval 1 day as date, event_type as grp,
       round(avg(value) + 1e-9, 6) as daily_avg from events group by 1, 2""",
)
def daily_group_avg_direct(spark, d):
    out = op.daily_average(table(spark, d, "events"), "ts", "event_type", "value")
    return out.select("date", "grp", six("daily_avg").alias("daily_avg"))


@query(
    "moving_avg_7d",
    DAILY_SQL + "select date::timestamp as date, grp, round(m + 1e-9, 6) as moving_avg from m",
)
def moving_avg_7d(spark, d):
    out = op.moving_average(daily(spark, d))
    return out.select("date", "grp", six("moving_avg").alias("moving_avg"))


@query(
    "window_first_last",
    DAILY_SQL
    + "select date::timestamp as date, grp, round(f + 1e-9, 6) as first_avg, round(l + 1e-9, 6) as last_avg from m",
)
def window_first_last(spark, d):
    return _trend(spark, d).select(
        "date", "grp", six("first_avg").alias("first_avg"), six("last_avg").alias("last_avg")
    )


@query("percent_change", DAILY_SQL + "select date::timestamp as date, grp, round(pct + 1e-9, 6) as pct from m")
def percent_change(spark, d):
    return _trend(spark, d).select("date", "grp", six("pct").alias("pct"))


@query(
    "top_group_per_day",
    DAILY_SQL
    + """select date::timestamp as date, grp as top_group, round(pct + 1e-9, 6) as highest_increase
    from (select *, row_number() over (partition by date order by pct desc nulls last, grp desc) r from m) where r = 1""",
)
def top_group_per_day(spark, d):
    return op.top_increase(_trend(spark, d)).select(
        "date", "top_group", six("highest_increase").alias("highest_increase")
    )


@query(
    "window_struct_fields",
    """select date_trunc('day', ts)::timestamp as window_start,
       date_trunc('day', ts)::timestamp + interval 1 day as window_end, count(*) as n from events group by 1, 2""",
)
def window_struct_fields(spark, d):
    from tallystream.functions.scalars import window_end, window_start

    return (
        table(spark, d, "events")
        .groupBy(F.window("ts", "1 day").alias("w"))
        .agg(F.count("*").alias("n"))
        .select(window_start("w").alias("window_start"), window_end("w").alias("window_end"), "n")
    )
