"""Count windows, routing, numbering and text functions over events and part."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystream.functions import scalars as fn
from tallystream.operators import countwindow as cw
from tallystream.operators import ordered
from tallystream.plans.registry import query, six
from tallystream.plans.tables import readings, table

# Fixed values of the query set: window settings of the five keys.
WINDOWS = [
    ("click", 10, 5, "average"),
    ("view", 10, 5, "sum"),
    ("error", 10, 5, "max"),
    ("signup", 12, 4, "min"),
]


def config(spark):
    rows = ", ".join(map(str, WINDOWS))
    return spark.sql(f"select * from values {rows} as c(key, window_size, slide, fn)")


CONFIG_SQL = "c(key, window_size, slide, fn) as (values " + ", ".join(map(str, WINDOWS)) + ")"

N_SQL = """with n as (select event_type as key, event_id, ts, value,
  row_number() over (partition by event_type order by event_id) - 1 as rn from events)"""


def _frames(size, keys="key", rn="rn", source="n"):
    return f""", w as (select *, avg(value) over f as a, max(value) over f as mx, min(value) over f as mn,
  sum(value) over f as sm from {source} window f as
  (partition by {keys} order by {rn} rows between {size - 1} preceding and current row))"""


@query(
    "count_window_agg",
    N_SQL
    + _frames(10)
    + """ select key, ((rn - 9) // 5)::bigint as k, round(a + 1e-9, 6) as average, mx as "max", ts
    from w where rn >= 9 and (rn - 9) % 5 = 0""",
)
def count_window_agg(spark, d):
    out = cw.count_window(readings(spark, d), "key", "seq", "value", 10, 5, ["average", "max"], ts="ts")
    return out.withColumn("average", six("average"))


@query(
    "count_window_overlapping",
    N_SQL
    + _frames(100)
    + """ select key, ((rn - 99) // 7)::bigint as k, round(a + 1e-9, 6) as average, mn as "min"
    from w where rn >= 99 and (rn - 99) % 7 = 0""",
)
def count_window_overlapping(spark, d):
    out = cw.count_window(readings(spark, d), "key", "seq", "value", 100, 7, ["average", "min"])
    return out.withColumn("average", six("average"))


@query(
    "named_aggregate",
    """select event_type as key, round(avg(value) + 1e-9, 6) as average, round(sum(value), 4) as "sum",
       max(value) as "max", min(value) as "min" from events group by 1""",
)
def named_aggregate(spark, d):
    columns = {name: cw.named_aggregate(name.upper())("value") for name in cw.AGGREGATES}
    columns["average"] = six(columns["average"])
    columns["sum"] = F.round(columns["sum"], 4)
    return readings(spark, d).groupBy("key").agg(*[c.alias(n) for n, c in columns.items()])


@query(
    "per_key_config_agg",
    N_SQL.replace("with n", f"with {CONFIG_SQL}, n")
    + """, w as (select n.*, window_size, slide, fn,
         avg(value) over (partition by n.key order by rn rows between 9 preceding and current row) as a10,
         sum(value) over (partition by n.key order by rn rows between 9 preceding and current row) as s10,
         max(value) over (partition by n.key order by rn rows between 9 preceding and current row) as x10,
         min(value) over (partition by n.key order by rn rows between 11 preceding and current row) as n12
         from n join c on n.key = c.key)
      select key, ((rn - window_size + 1) // slide)::bigint as k, fn,
        round(case fn when 'average' then a10 when 'sum' then s10 when 'max' then x10 else n12 end + 1e-9, 6) as value
      from w where rn >= window_size - 1 and (rn - window_size + 1) % slide = 0""",
)
def per_key_config_agg(spark, d):
    out = cw.count_window_by_config(readings(spark, d), config(spark), "key", "seq", "value")
    return out.withColumn("value", six("value"))


@query(
    "lane_count_window",
    N_SQL
    + ", l as (select key, (rn % 4)::int as lane, value, ts, rn // 4 as lrn from n)"
    + _frames(10, "key, lane", "lrn", "l")
    + """ select key, lane, ((lrn - 9) // 5)::bigint as k, round(a + 1e-9, 6) as average
    from w where lrn >= 9 and (lrn - 9) % 5 = 0""",
)
def lane_count_window(spark, d):
    out = cw.lane_window(readings(spark, d), "key", "seq", "value", 10, 5, n=4)
    return out.withColumn("average", six("average"))


def _spread(values: list[float]) -> float:
    return values[-1] - values[0]


@query(
    "custom_window_aggregate",
    N_SQL
    + """, w as (select *, value - lag(value, 9) over (partition by key order by rn) as spread from n)
    select key, ((rn - 9) // 5)::bigint as k, round(spread + 1e-9, 6) as value from w where rn >= 9 and (rn - 9) % 5 = 0""",
)
def custom_window_aggregate(spark, d):
    out = cw.count_window_apply(readings(spark, d), "key", "seq", "value", 10, 5, _spread)
    return out.withColumn("value", six("value"))


@query(
    "sequence_numbers",
    "select event_id, row_number() over (order by ts, event_id) - 1 as rn from events",
)
def sequence_numbers(spark, d):
    events = table(spark, d, "events").select("event_id", "ts")
    return ordered.number_rows(events, [], ["ts", "event_id"]).select("event_id", "rn")


@query(
    "running_window_frames",
    """select event_id, round(avg(value) over f + 1e-9, 6) as avg_10, max(value) over f as max_10 from events
       window f as (partition by event_type order by event_id rows between 9 preceding and current row)""",
)
def running_window_frames(spark, d):
    out = ordered.rolling(
        readings(spark, d).select("key", "seq", "value"), "key", "seq", 10, {"avg_10": F.avg("value"), "max_10": F.max("value")}
    )
    return out.select(F.col("seq").alias("event_id"), six("avg_10").alias("avg_10"), "max_10")


@query(
    "data_op_filter",
    "select event_type as key, count(*) as n from events where event_id % 50 <> 0 group by 1",
)
def data_op_filter(spark, d):
    from tallystream.operators.routing import data_ops

    return data_ops(readings(spark, d)).groupBy("key").agg(F.count("*").alias("n"))


@query(
    "route_by_key",
    f"""with {CONFIG_SQL} select event_type as key, fn is not null as routed, count(*) as n
    from events left join c on lower(event_type) = lower(c.key) group by 1, 2""",
)
def route_by_key(spark, d):
    routed, unrouted = cw.route(readings(spark, d), config(spark))
    both = routed.select("key", F.lit(True).alias("routed")).unionByName(
        unrouted.select("key", F.lit(False).alias("routed"))
    )
    return both.groupBy("key", "routed").agg(F.count("*").alias("n"))


@query(
    "key_match_ci",
    """select event_id, lower(event_type) = lower(case when event_id % 3 = 0 then 'VIEW' else 'Click' end) as same
       from events""",
)
def key_match_ci(spark, d):
    wanted = F.when(F.col("event_id") % 3 == 0, "VIEW").otherwise("Click")
    return table(spark, d, "events").select("event_id", fn.same_key("event_type", wanted).alias("same"))


@query("json_field", "select event_id, json_extract_string(props, '$.k')::int as k from events")
def json_field(spark, d):
    return table(spark, d, "events").select("event_id", fn.json_field("props", "k", "int").alias("k"))


@query(
    "flatten_payload",
    "select event_id, json_extract_string(props, '$.k')::int as k from events",
)
def flatten_payload(spark, d):
    parsed = table(spark, d, "events").select(
        F.struct("event_id", F.from_json("props", "k int")["k"].alias("k")).alias("data")
    )
    return fn.flatten_payload(parsed, "data")


@query(
    "iso_timestamp",
    "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as iso from events",
)
def iso_timestamp(spark, d):
    return table(spark, d, "events").select("event_id", fn.iso_timestamp("ts").alias("iso"))


@query(
    "title_case",
    """select p_partkey, trim(array_to_string(list_transform(regexp_split_to_array(p_name, '\\s'),
       lambda w: upper(w[1]) || w[2:]), ' ')) as title from part""",
)
def title_case(spark, d):
    return table(spark, d, "part").select("p_partkey", fn.title_case("p_name").alias("title"))
