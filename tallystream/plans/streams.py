"""Sources, sinks and streaming operators, each drained over a whole driver table.

Streams run in a session of their own (UTC, as Spark cuts day windows in UTC) and write to
the shared folder; the query returns what they wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystream.functions.scalars import NOT_SUBMITTED, classify_role
from tallystream.operators import ledger as lg
from tallystream.operators.ordered import number_rows
from tallystream.operators.sizing import broadcast_if_small
from tallystream.plans import tables as t
from tallystream.plans.ledger import (
    OFFER_SQL,
    REBORN_COMPLETIONS_SQL,
    REBORN_ENROLMENTS_SQL,
    REBORN_GRADES_SQL,
    REBORN_HISTORY_SQL,
    ROLE_SQL,
    ULOG_SQL,
)
from tallystream.plans.registry import query, six
from tallystream.plans.sensors import CONFIG_SQL, N_SQL, _frames, config
from tallystream.plans.trends import DAILY_SQL
from tallystream.session import cut_lineage, fresh_dir
from tallystream.sources import records as rec
from tallystream.streaming import countwindow as scw
from tallystream.streaming import events as sev
from tallystream.streaming import run as srun
from tallystream.streaming import state as sst
from tallystream.streaming import trends as strd


FILE_ROWS = 1_000_000
VOTE_BUCKETS = 128
GROUP_ROWS = 50_000  # of a micro-batch in one group of a stateful operator


def _session(spark: SparkSession) -> SparkSession:
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.shuffle.partitions", str(min(now, 2 * spark.sparkContext.defaultParallelism)))
    return own


def _stream(spark: SparkSession, d: str, name: str, folder: str | None = None) -> DataFrame:
    # written as a pattern, because a file stream takes a single file only that way
    path = folder or f"{d}/{name}[.]parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def _zoned(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def _unzoned(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _drain(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    out = fresh_dir(spark, label)
    srun.run_stream(df, out, fresh_dir(spark, f"{label}-checkpoint"))
    return spark.read.schema(df.schema).parquet(out)


# -- trends ---------------------------------------------------------------------------


def _grouped_events(spark: SparkSession, d: str) -> DataFrame:
    events = _zoned(_stream(spark, d, "events").select("ts", "user_id", "value"))
    return events.join(t.membership(spark, d).withColumnRenamed("member", "user_id"), "user_id")


CLOSED_DAY = " where date <= (select max(ts) from events) - interval 1 day"
CLOSED_LABEL = " where date <= (select max(ts) from events)"


@query(
    "watermarked_daily",
    DAILY_SQL + "select date::timestamp as date, grp, round(a + 1e-9, 6) as daily_avg from d" + CLOSED_DAY,
)
def watermarked_daily(spark, d):
    own = _session(spark)
    out = _drain(strd.stream_daily_avg(_grouped_events(own, d), "ts", "grp", "value"), "daily")
    return _unzoned(out, "date").select("date", "grp", six("daily_avg").alias("daily_avg"))


@query(
    "chained_windows",
    DAILY_SQL
    + "select date::timestamp as date, grp, round(m + 1e-9, 6) as moving_avg, round(pct + 1e-9, 6) as pct from m"
    + CLOSED_LABEL,
)
def chained_windows(spark, d):
    own = _session(spark)
    out = _drain(strd.stream_moving_avg(_grouped_events(own, d), "ts", "grp", "value"), "moving")
    return _unzoned(out, "date").select(
        "date", "grp", six("moving_avg").alias("moving_avg"), six("pct").alias("pct")
    )


@query(
    "streaming_top_group",
    DAILY_SQL
    + """select date::timestamp as date, grp as top_group, round(pct + 1e-9, 6) as highest_increase
    from (select *, row_number() over (partition by date order by pct desc nulls last, grp desc) r from m)"""
    + CLOSED_LABEL
    + " and r = 1",
)
def streaming_top_group(spark, d):
    own = _session(spark)
    out = _drain(strd.stream_top_group(_grouped_events(own, d), "ts", "grp", "value"), "top")
    return _unzoned(out, "date").select(
        "date", "top_group", six("highest_increase").alias("highest_increase")
    )


# -- count windows --------------------------------------------------------------------


def _reading_stream(spark: SparkSession, d: str) -> DataFrame:
    return _zoned(_stream(spark, d, "events")).select(
        F.col("event_type").alias("key"), F.col("event_id").alias("seq"), "value", "ts"
    )


AVERAGE_SQL = (
    N_SQL + _frames(10) + " select key, ((rn - 9) // 5)::bigint as k, round(a + 1e-9, 6) as value, ts from w where rn >= 9 and (rn - 9) % 5 = 0"
)


@query("stateful_count_window", AVERAGE_SQL)
def stateful_count_window(spark, d):
    own = _session(spark)
    out = _drain(scw.stream_count_window(_reading_stream(own, d), "key", "seq", "value", 10, 5), "count")
    return _unzoned(out, "ts").withColumn("value", six("value"))


def _numbered_stream(spark: SparkSession, d: str) -> DataFrame:
    """Readings that carry their number within their key, in several files and micro-batches."""
    readings = _zoned(t.readings(spark, d)).select("key", "seq", "value", "ts")
    folder = fresh_dir(spark, "numbered")
    number_rows(readings, "key", "seq", "n").repartition(4, "seq").write.parquet(folder)
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(folder)


@query("numbered_count_window", AVERAGE_SQL)
def numbered_count_window(spark, d):
    """Readings that are numbered by their source; a busy key uses many tasks."""
    own = _session(spark)
    out = _drain(scw.stream_count_window(_numbered_stream(own, d), "key", "n", "value", 10, 5, dense=True), "count")
    return _unzoned(out, "ts").withColumn("value", six("value"))


@query(
    "streaming_lanes",
    """with n as (select event_type as key, (event_id % 4)::int as lane, value, row_number() over
      (partition by event_type, event_id % 4 order by event_id) - 1 as rn from events)"""
    + _frames(10, "key, lane")
    + " select key, lane, ((rn - 9) // 5)::bigint as k, mx as value from w where rn >= 9 and (rn - 9) % 5 = 0",
)
def streaming_lanes(spark, d):
    own = _session(spark)
    out = scw.stream_count_window(_reading_stream(own, d), "key", "seq", "value", 10, 5, "max", lanes=4)
    return _drain(out, "lanes").select("key", "lane", "k", "value")


BY_CONFIG_SQL = (
    N_SQL.replace("with n", f"with {CONFIG_SQL}, n")
    + """, w as (select n.*, window_size, slide, fn,
         avg(value) over (partition by n.key order by rn rows between 9 preceding and current row) as a10,
         sum(value) over (partition by n.key order by rn rows between 9 preceding and current row) as s10,
         max(value) over (partition by n.key order by rn rows between 9 preceding and current row) as x10,
         min(value) over (partition by n.key order by rn rows between 11 preceding and current row) as n12
         from n join c on n.key = c.key)
      select key, ((rn - window_size + 1) // slide)::bigint as k, fn,
        round(case fn when 'average' then a10 when 'sum' then s10 when 'max' then x10 else n12 end + 1e-9, 6) as value
      from w where rn >= window_size - 1 and (rn - window_size + 1) % slide = 0"""
)


@query("streaming_by_config", BY_CONFIG_SQL)
def streaming_by_config(spark, d):
    own = _session(spark)
    out = scw.stream_count_window_by_config(_reading_stream(own, d), config(own), "key", "seq", "value")
    return _drain(out, "config").withColumn("value", six("value"))


@query("numbered_by_config", BY_CONFIG_SQL)
def numbered_by_config(spark, d):
    own = _session(spark)
    out = scw.stream_count_window_by_config(_numbered_stream(own, d), config(own), "key", "n", "value", dense=True)
    return _drain(out, "config").withColumn("value", six("value"))


# -- events ---------------------------------------------------------------------------


@query("streaming_dedup", "select event_id, user_id, event_type from events")
def streaming_dedup(spark, d):
    """Every event arrives twice and comes out once."""
    own = _session(spark)
    once = _zoned(_stream(own, d, "events").select("event_id", "ts", "user_id", "event_type"))
    out = sev.stream_dedup(once.unionByName(once), ["event_id"], "ts", "1 day")
    return _drain(out, "dedup").drop("ts")


@query(
    "stream_stream_wait",
    """select f.event_id, g.event_id as ref_id from events f join events g on f.user_id = g.user_id
       and g.ts >= f.ts - interval 6 hours and g.ts <= f.ts + interval 2 hours
       where f.event_type = 'purchase' and g.event_type = 'signup'""",
)
def stream_stream_wait(spark, d):
    """Purchases with the sign-ups of their user, which may arrive up to two hours later."""
    own = _session(spark)
    events = _zoned(_stream(own, d, "events"))
    facts = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    dims = events.filter("event_type = 'signup'").select(
        F.col("event_id").alias("ref_id"), "user_id", F.col("ts").alias("ref_ts")
    )
    out = sev.stream_await_join(facts, dims, ["user_id"], "ts", "ref_ts", "6 hours", "2 hours")
    return _drain(out.select("event_id", "ref_id"), "wait")


# -- state tables -----------------------------------------------------------------------


def _in_parts(log: DataFrame, parts: int = 3) -> list[DataFrame]:
    """A log as consecutive ranges of ``seq``."""
    log = cut_lineage(log)
    cuts = log.agg(F.percentile_approx("seq", [i / parts for i in range(1, parts)], 1000)).first()[0]
    edges = [None, *cuts, None]
    after = lambda c: F.lit(True) if c is None else F.col("seq") > c
    until = lambda c: F.lit(True) if c is None else F.col("seq") <= c
    return [log.filter(after(a) & until(b)) for a, b in zip(edges, edges[1:])]


def _kept(log: DataFrame, run, **groups: tuple[int, tuple[str, ...]]) -> str:
    """The log comes in part by part; ``run(stream, path, checkpoint)`` is started anew for each of
    them and goes on from its checkpoint. Returns the path of what it keeps.

    ``groups``: numbers of groups that ``run`` also takes, each as the least number and the key whose
    events are dealt to so many groups; there are more where a part holds more than
    ``GROUP_ROWS`` events of one key for each.
    """
    spark = log.sparkSession
    folder, path, checkpoint = (fresh_dir(spark, f"state-{n}") for n in ("log", "tables", "checkpoint"))
    parts = _in_parts(log)
    wanted = {name: max(least, *(-(-_most(part, key) // GROUP_ROWS) for part in parts)) for name, (least, key) in groups.items()}
    for part in parts:
        part.write.mode("append").parquet(folder)
        run(spark.readStream.schema(log.schema).parquet(folder), path, checkpoint, **wanted)
    return path


def _most(log: DataFrame, key: tuple[str, ...]) -> int:
    """Rows of the key that has most of them."""
    return log.groupBy(*key).count().agg(F.max("count")).first()[0] or 0


def _user_table(spark: SparkSession, log: DataFrame) -> DataFrame:
    users = log.select("user_id", "seq", "tie", "name", "email", "role")
    path = _kept(users, lambda stream, *to: sst.maintain_latest(stream, ["user_id"], ["seq", "tie"], *to))
    return sst.latest(spark, path, ["user_id"]).withColumn("role", classify_role("role"))


def _course_table(spark: SparkSession, log: DataFrame) -> DataFrame:
    events = log.filter(F.col("type").isin("CREATE", "DELETE")).withColumnRenamed("course_id", "course")
    none = {c: F.lit(None).cast(kind) for c, kind in (("student", "bigint"), ("project", "string"), ("grade", "int"))}
    path = _kept(events.withColumns(none), lambda stream, *to: sst.maintain_tables(stream, *to, t.OFFER_ORDER, salts=1, buckets=8))  # no students here
    return sst.courses(spark, path, ["name", "admin_id"])


@query(
    "streaming_state_tables",
    f"""with {ULOG_SQL}, {OFFER_SQL} select 'users' as tbl, user_id as id, name, role = 'STUDENT' as flag from ustate
        union all select 'courses', course_id, name, is_deleted from ostate""",
)
def streaming_state_tables(spark, d):
    """Users and courses, each kept from its log."""
    own = _session(spark)
    users = _user_table(own, t.user_log(own, d)).select(
        F.lit("users").alias("tbl"), F.col("user_id").alias("id"), "name", (F.col("role") == "STUDENT").alias("flag")
    )
    courses = _course_table(own, t.offer_log(own, d))
    return users.unionByName(courses.select(F.lit("courses").alias("tbl"), F.col("course").alias("id"), "name", F.col("is_deleted").alias("flag")))


@query(
    "streaming_course_state",
    f"with {OFFER_SQL} select o.course_id, name, admin_id, is_deleted, n::bigint as incarnation from ostate o"
    " join (select course_id, count(*) as n from offers where type = 'CREATE' group by 1) using (course_id)",
)
def streaming_course_state(spark, d):
    own = _session(spark)
    return _course_table(own, t.offer_log(own, d)).withColumnRenamed("course", "course_id")


@query("streaming_user_state", f"with {ULOG_SQL} select user_id, name, email, role from ustate")
def streaming_user_state(spark, d):
    own = _session(spark)
    return _user_table(own, t.user_log(own, d)).select("user_id", "name", "email", "role")


@query(
    "streaming_vote_state",
    """with li as (select o_custkey as student, o_orderpriority as course, l_returnflag as project,
         date_diff('day', date '1970-01-01', l_shipdate::date) as seq, (l_linestatus = 'O')::int as rank,
         l_quantity::int as grade from lineitem join orders on l_orderkey = o_orderkey),
       sb as (select student, course, project, max((seq, rank, grade)) as ls from li where rank = 1 group by all),
       rt as (select li.student, li.course, li.project, arg_min(grade, (seq, rank, grade)) as g from li
         join sb using (student, course, project) where rank = 0 and (seq, rank, grade) > ls group by all)
       select k.student, k.course, k.project, (case when ls is null then -2 else coalesce(g, -1) end)::int as vote
       from (select distinct student, course, project from li) k
       left join sb using (student, course, project) left join rt using (student, course, project)""",
)
def streaming_vote_state(spark, d):
    """Votes of one course object each, whatever becomes of the course."""
    own = _session(spark)
    log = t.work_log(own, d)

    def run(stream, path, checkpoint, buckets):
        changes = sst.fold_cells(stream, t.WORK_ORDER, buckets)
        srun.run_stream(changes, f"{path}/tables", checkpoint, partition_by=["table"])

    voted = sst.votes(sst.read_changes(own, _kept(log, run, buckets=(VOTE_BUCKETS, ())), "history")).drop("incarnation")
    cells = log.select(*lg.CELL).distinct()
    return cells.join(voted, lg.CELL, "left").fillna(NOT_SUBMITTED, ["vote"])


@query(
    "streaming_enrolment_state",
    """select o_custkey as student, o_orderpriority as course,
       min(date_diff('day', date '1970-01-01', o_orderdate::date)) as since from orders group by 1, 2""",
)
def streaming_enrolment_state(spark, d):
    own = _session(spark)
    key = ["student", "course"]
    log = t.enrol_log(own, d).select(F.col("user_id").alias("student"), F.col("course_id").alias("course"), "seq")
    path = _kept(log, lambda stream, *to: sst.maintain_least(stream, key, "seq", *to))
    return sst.least(own, path, key, "seq").withColumnRenamed("seq", "since")


def _campus(spark: SparkSession, d: str) -> str:
    """Courses that are deleted and made anew, with all that happens in them."""

    def run(stream, path, checkpoint, salts, buckets):
        sst.maintain_tables(stream, path, checkpoint, t.CAMPUS_ORDER, salts, buckets)

    return _kept(t.campus_log(spark, d), run, salts=(8, ("course",)), buckets=(32, ()))


def _enrolled(spark: SparkSession, d: str, path: str) -> DataFrame:
    students = t.users(spark, d).filter("role = 'STUDENT'").select(F.col("user_id").alias("student"))
    return sst.read_changes(spark, path, "enrolments").join(students, "student", "left_semi").select("student", "course", "incarnation", F.col("seq").alias("since"))


@query("streaming_reborn_enrolments", REBORN_ENROLMENTS_SQL)
def streaming_reborn_enrolments(spark, d):
    own = _session(spark)
    path = _campus(own, d)
    return sst.of_open_courses(_enrolled(own, d, path), sst.courses(own, path)).select("student", "course", "since")


@query("streaming_reborn_grades", REBORN_GRADES_SQL)
def streaming_reborn_grades(spark, d):
    """A cell for each enrolment and project of the courses as they are now."""
    own = _session(spark)
    path = _campus(own, d)
    now = sst.courses(own, path)
    enrolled = sst.of_open_courses(_enrolled(own, d, path), now).select("student", "course", "incarnation")
    projects = sst.of_open_courses(sst.read_changes(own, path, "projects"), now).select("course", "incarnation", "project")
    voted = sst.votes(sst.read_changes(own, path, "history"))
    cells = enrolled.join(broadcast_if_small(projects), ["course", "incarnation"])
    return cells.join(voted, [*lg.CELL, "incarnation"], "left").fillna(NOT_SUBMITTED, ["vote"]).select(*lg.CELL, "vote")


@query("streaming_grade_history", REBORN_HISTORY_SQL)
def streaming_grade_history(spark, d):
    """Every change of a cell, in all incarnations of its course."""
    own = _session(spark)
    path = _campus(own, d)
    changes = sst.read_changes(own, path, "history")
    return changes.join(_enrolled(own, d, path), ["student", "course", "incarnation"], "left_semi").select(
        *lg.CELL, "seq", "type", "old_vote", "new_vote"
    )


@query("streaming_completions", REBORN_COMPLETIONS_SQL)
def streaming_completions(spark, d):
    """Recorded when the last needed rating comes in; they outlive their incarnation."""
    own = _session(spark)
    path = _campus(own, d)
    done = sst.read_changes(own, path, "completions").join(_enrolled(own, d, path), ["student", "course", "incarnation"], "left_semi")
    return done.groupBy("student", "course").agg(F.min("seq").alias("done_at"))


# -- sources and sinks ----------------------------------------------------------------


def _sensor_lines(spark: SparkSession, d: str) -> str:
    """The events written as one JSON message per line."""
    folder = fresh_dir(spark, "sensor-lines")
    message = F.to_json(F.struct("key", "value", "op", F.col("seq").alias("sequenceNumber")))
    t.readings(spark, d).select(message.alias("value")).write.text(folder)
    return folder


SENSOR_SQL = """select event_type as key, value, (case when event_id % 50 = 0 then 3 else 0 end)::int as op,
  event_id as seq from events"""


@query("json_stream_source", SENSOR_SQL)
def json_stream_source(spark, d):
    own = _session(spark)
    stream = rec.read_json(own, _sensor_lines(own, d), rec.SENSOR_READING, streaming=True)
    return _drain(stream, "json").withColumnRenamed("sequenceNumber", "seq")


@query("sensor_source", SENSOR_SQL)
def sensor_source(spark, d):
    return rec.read_sensor(spark, _sensor_lines(spark, d))


def _sparse_log(spark: SparkSession, d: str) -> DataFrame:
    """Course and project events in the sparse message layout, ids as text."""
    offers = t.offer_log(spark, d).select(
        F.lit("course").alias("subject"),
        "type",
        F.when(F.col("type") == "CREATE", F.concat_ws(",", "course_id", "name", "admin_id", F.lit("false")))
        .when(F.col("type") == "DELETE", F.col("course_id").cast("string"))
        .alias("data"),
        F.when(F.col("type") == "ENROLL", F.col("user_id").cast("string")).alias("user_id"),
        F.col("course_id").cast("string").alias("course_id"),
    )
    work = t.work_log(spark, d).select(
        F.lit("project").alias("subject"),
        "type",
        F.col("student").cast("string").alias("user_id"),
        F.col("course").alias("course_id"),
        F.col("project").alias("project_id"),
        F.when(F.col("type") == "SUBMIT", F.lit("file")).alias("attachment"),
        F.when(F.col("type") == "RATE", F.col("grade")).alias("grade"),
    )
    return lg.union_logs(offers, work)


LOG_SQL = """offers as (select case l_linenumber when 1 then 'CREATE' when 2 then 'DELETE' else 'ENROLL' end as type,
   l_suppkey as c, l_partkey as p, l_orderkey as o from lineitem),
 work as (select case l_linestatus when 'O' then 'SUBMIT' else 'RATE' end as type, o_custkey as s, o_orderpriority as c,
   l_returnflag as p, l_quantity::int as g from lineitem join orders on l_orderkey = o_orderkey)"""


@query(
    "event_log_source",
    f"""with {LOG_SQL} select type, case type when 'CREATE' then c || ',course ' || p || ',' || o || ',false'
         when 'DELETE' then c::varchar end as data, case type when 'ENROLL' then p::varchar end as user_id,
         case type when 'ENROLL' then c::varchar end as course_id, null::varchar as project_id,
         null::varchar as attachment, null::int as grade from offers
       union all select type, null, s::varchar, c, p, case type when 'SUBMIT' then 'file' end,
         case type when 'RATE' then g end from work""",
)
def event_log_source(spark, d):
    folder = fresh_dir(spark, "event-lines")
    rec.encode_events(_sparse_log(spark, d)).select("value").write.text(folder)
    return rec.read_event_log(spark, folder)


@query(
    "event_log_encode",
    f"""with {LOG_SQL} select topic, key, count(*) as n, sum(length(value))::bigint as chars from (
       select 'course-events' as topic, case type when 'ENROLL' then p else c end::varchar as key,
         case type when 'CREATE' then '{{"type":"CREATE","data":"' || c || ',course ' || p || ',' || o || ',false"}}'
         when 'DELETE' then '{{"type":"DELETE","data":"' || c || '"}}'
         else '{{"type":"ENROLL","userId":"' || p || '","courseId":"' || c || '"}}' end as value from offers
       union all select 'project-events', s::varchar, '{{"type":"' || type || '","userId":"' || s || '","courseId":"' || c ||
         '","projectId":"' || p || case type when 'SUBMIT' then '","allegato":"file"}}' else '","voto":"' || g || '"}}' end from work)
       group by 1, 2""",
)
def event_log_encode(spark, d):
    return (
        rec.encode_events(_sparse_log(spark, d))
        .groupBy("topic", "key")
        .agg(F.count("*").alias("n"), F.sum(F.length("value")).alias("chars"))
    )


def _user_records(spark: SparkSession, d: str) -> DataFrame:
    """User records as text; those of one segment have lost their role field."""
    users = t.users(spark, d)
    short = F.concat_ws(",", "user_id", "name", "email", F.lit("secret"))
    whole = F.concat_ws(",", short, "role", F.lit("extra"))
    return users.select(F.when(F.col("email") == "BUILDING", short).otherwise(whole).alias("value"))


@query(
    "csv_record_decode",
    f"""select c_custkey as "userId", case when c_mktsegment <> 'BUILDING' then c_name end as name,
       case when c_mktsegment <> 'BUILDING' then {ROLE_SQL.format('c_custkey')} end as role,
       c_mktsegment = 'BUILDING' as quarantined from customer""",
)
def csv_record_decode(spark, d):
    kinds = ["bigint", "string", "string", "string", "string"]
    good, bad = rec.decode_csv(_user_records(spark, d), "value", rec.USER_FIELDS, kinds)
    kept = good.select("userId", "name", "role", F.lit(False).alias("quarantined"))
    lost = bad.select(
        F.split("value", ",")[0].cast("bigint").alias("userId"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("role"),
        F.lit(True).alias("quarantined"),
    )
    return kept.unionByName(lost)


@query("json_batch_sink", AVERAGE_SQL.replace(", ts from w", " from w"))
def json_batch_sink(spark, d):
    own = _session(spark)
    windows = scw.stream_count_window(_reading_stream(own, d), "key", "seq", "value", 10, 5)
    out = fresh_dir(own, "json-out")
    running = srun.write_json(windows, out, fresh_dir(own, "json-checkpoint"), seconds=1)
    running.processAllAvailable()
    running.stop()
    written = own.read.schema("key string, k bigint, value double").json(out)
    return written.withColumn("value", six("value"))


@query("console_or_table_sink", "select event_type as key, event_id as seq, value from events")
def console_or_table_sink(spark, d):
    own = _session(spark)
    path = fresh_dir(own, "shown")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = _reading_stream(own, d).select("key", "seq", "value")
    running = srun.to_table(rows, name, path, fresh_dir(own, "shown-checkpoint"))
    running.processAllAvailable()
    running.stop()
    return own.table(name)


@query("micro_batch_flush", "select event_type as key, event_id as seq, value from events")
def micro_batch_flush(spark, d):
    """A timed query that ends by itself when the input dries up."""
    own = _session(spark)
    out = fresh_dir(own, "flush-out")
    rows = _reading_stream(own, d).select("key", "seq", "value")
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_dir(own, "flush-checkpoint"))
    running = srun.flush_trigger(writer, seconds=1).start()
    running.processAllAvailable()
    srun.stop_when_idle(running, seconds=1)
    return own.read.schema(rows.schema).parquet(out)


@query("idle_stop", "select event_type as key, event_id as seq, value from events")
def idle_stop(spark, d):
    """A query without an end, stopped once nothing has come in for a second."""
    own = _session(spark)
    out = fresh_dir(own, "idle-out")
    rows = _reading_stream(own, d).select("key", "seq", "value")
    running = srun.run_stream(rows, out, fresh_dir(own, "idle-checkpoint"), available_now=False)
    running.processAllAvailable()
    srun.stop_when_idle(running, seconds=1)
    return own.read.schema(rows.schema).parquet(out)


@query("replay_from_earliest", "select event_id, user_id, event_type from events")
def replay_from_earliest(spark, d):
    """Every event arrives twice, in three micro-batches. The second one fails after its rows are
    written; the query is taken up from its checkpoint, with the events it remembers."""
    own = _session(spark)
    events = _zoned(t.table(own, d, "events").select("event_id", "ts", "user_id", "event_type")).withColumn("seq", F.col("event_id"))
    out, folder, checkpoint = (fresh_dir(own, f"replay-{n}") for n in ("out", "log", "checkpoint"))
    failed: list[int] = []

    def step(batch: DataFrame, batch_id: int) -> None:
        srun.write_batch_once(batch, batch_id, out)
        if batch_id > 0 and not failed and not batch.isEmpty():
            failed.append(batch_id)
            raise RuntimeError("lost inside the micro-batch")

    for part in _in_parts(events):
        part.write.mode("append").parquet(folder)
        once = own.readStream.schema(events.schema).parquet(folder)
        once = sev.stream_dedup(once.unionByName(once), ["event_id"], "ts", "1 day")
        srun.resume(lambda: srun.run_batches(once, step, checkpoint))  # noqa: B023
    return own.read.parquet(out).select("event_id", "user_id", "event_type")


@query("write_batch_once", "select event_type as key, event_id as seq, value from events")
def write_batch_once(spark, d):
    """Each micro-batch is written twice under its number, as in a replay."""
    own = _session(spark)
    out = fresh_dir(own, "once-out")
    rows = _reading_stream(own, d).select("key", "seq", "value")

    def twice(batch: DataFrame, batch_id: int) -> None:
        srun.write_batch_once(batch, batch_id, out)
        srun.write_batch_once(batch, batch_id, out)

    srun.run_batches(rows, twice, fresh_dir(own, "once-checkpoint"))
    return own.read.parquet(out).drop("batch")


@query(
    "write_tables_once",
    """select 'reading' as tbl, event_id as seq, value from events
       union all select 'alarm', event_id, null from events where value > 90""",
)
def write_tables_once(spark, d):
    """A reading and the alarm it raises become visible together."""
    own = _session(spark)
    out = fresh_dir(own, "tables-out")
    rows = _reading_stream(own, d).select("seq", "value")

    def both(batch: DataFrame, batch_id: int) -> None:
        srun.write_tables_once({"reading": batch, "alarm": batch.filter("value > 90").select("seq")}, batch_id, out)

    srun.run_batches(rows, both, fresh_dir(own, "tables-checkpoint"))
    reading, alarm = (srun.read_table(own, out, name).withColumn("tbl", F.lit(name)) for name in ("reading", "alarm"))
    return reading.unionByName(alarm).select("tbl", "seq", "value")


@query(
    "late_row_report",
    """select count(*) filter (ts <= date_trunc('milliseconds', edge) - interval 1 day)::bigint as dropped,
       3 * count(*)::bigint as sent from events, (select max(ts) as edge from events)""",
)
def late_row_report(spark, d):
    """The events arrive three times in three micro-batches. The watermark of the first
    one applies from the third on, where all rows behind it are dropped as late."""
    own = _session(spark)
    folder = fresh_dir(own, "late-log")
    events = t.table(own, d, "events").select("event_id", "ts")
    files = max(1, -(-events.count() // FILE_ROWS))  # a copy each time
    for _ in range(3):
        events.repartition(files, "event_id").write.mode("append").parquet(folder)
    stream = _zoned(own.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(folder))
    once = sev.stream_dedup(stream, ["event_id"], "ts", "1 day")
    late = srun.LateRows()
    own.streams.addListener(late)
    try:
        dropped = late.of(srun.run_stream(once, fresh_dir(own, "late-out"), fresh_dir(own, "late-checkpoint")))
    finally:
        own.streams.removeListener(late)
    sent = own.read.parquet(folder).agg(F.count("*").alias("sent"))
    return sent.select(F.lit(dropped).cast("bigint").alias("dropped"), "sent")
