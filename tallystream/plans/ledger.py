"""State tables, read queries and admission checks over customer, orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystream.functions import scalars as fn
from tallystream.operators import campus
from tallystream.operators import ledger as lg
from tallystream.operators.ordered import first_per_key, latest_per_key
from tallystream.plans import tables as t
from tallystream.plans.registry import query
from tallystream.session import cut_lineage

ROLE_SQL = "case {0} % 10 when 0 then 'PROFESSOR' when 9 then 'ADMIN' else 'STUDENT' end"
DAY_SQL = "date_diff('day', date '1970-01-01', {0}::date)"

BASE_SQL = f"""users as (select c_custkey as user_id, c_name as name, c_mktsegment as email,
   {ROLE_SQL.format('c_custkey')} as role from customer),
 courses as (select o_orderpriority as course_id, max(o_orderstatus) as name, min(o_custkey) as admin_id,
   contains(o_orderpriority, 'NOT') as is_deleted from orders group by o_orderpriority),
 enrol as (select o_custkey as student, o_orderpriority as course, min({DAY_SQL.format('o_orderdate')}) as since
   from orders where o_custkey in (select user_id from users where role = 'STUDENT')
   and o_orderpriority in (select course_id from courses where not is_deleted) group by 1, 2),
 plog as (select o_orderpriority as course, l_returnflag as project, l_suppkey * 10 as prof_id,
   {DAY_SQL.format('l_shipdate')} + case l_returnflag when 'A' then 0 when 'N' then 400 else 800 end as seq
   from lineitem join orders on l_orderkey = o_orderkey),
 proj as (select course, project, seq, prof_id from (select *, row_number() over
   (partition by course, project order by seq, prof_id) r from plog) where r = 1
   and course in (select course_id from courses where not is_deleted)),
 cells as (select student, course, project from enrol join proj using (course)),
 allwork as (select case l_linestatus when 'O' then 'SUBMIT' else 'RATE' end as type, o_custkey as student,
   o_orderpriority as course, l_returnflag as project, {DAY_SQL.format('l_shipdate')} as seq,
   case l_linestatus when 'O' then 1 else 0 end as rank, l_quantity::int as grade
   from lineitem join orders on l_orderkey = o_orderkey),
 work as (select w.* from allwork w join enrol e on w.student = e.student and w.course = e.course
   join proj p on w.course = p.course and w.project = p.project where w.seq >= p.seq)"""

VOTE_SQL = (
    BASE_SQL
    + """, sb as (select student, course, project, {pick}((seq, rank, grade)) as ls from work where type = 'SUBMIT' group by all),
 rt as (select w.student, w.course, w.project, arg_min(grade, (seq, rank, grade)) as g from work w
   join sb using (student, course, project) where type = 'RATE' and (seq, rank, grade) > ls group by all),
 votes as (select c.student, c.course, c.project, (case when ls is null then -2 else coalesce(g, -1) end)::int as vote
   from cells c left join sb using (student, course, project) left join rt using (student, course, project))"""
)

# A cell is settled event by event in time order; a rating counts right after a submission only.
HISTORY_SQL = (
    BASE_SQL
    + """, o as (select *, row_number() over (partition by student, course, project order by seq, rank, grade) as i,
   lag(type) over (partition by student, course, project order by seq, rank, grade) as before from work),
 k as (select *, case type when 'SUBMIT' then -1 else grade end as new_vote from o where type = 'SUBMIT' or before = 'SUBMIT'),
 hist as (select student, course, project, seq, rank, grade, type,
   coalesce(lag(new_vote) over (partition by student, course, project order by i), -2) as old_vote, new_vote from k)"""
)

DONE_SQL = (
    HISTORY_SQL
    + """, run as (select *, sum((new_vote >= 18)::int - (old_vote >= 18)::int) over (partition by student, course
   order by seq, rank, grade, project rows unbounded preceding) as passes from hist),
 done as (select student, course, min(seq) as done_at from run where type = 'RATE'
   and passes = (select count(*) from proj where proj.course = run.course and proj.seq <= run.seq) group by 1, 2)"""
)


def _sql(parts: str, tail: str) -> str:
    return f"with {parts} {tail}"


# -- state tables derived from the driver tables --------------------------------------


def _courses(spark, d):
    return t.campus_courses(spark, d)


def _enrolments(spark, d):
    return lg.enrolments(t.enrol_log(spark, d), t.users(spark, d), _courses(spark, d))


def _projects(spark, d):
    """Small next to the log it comes from and used several times per query, so written once."""
    return cut_lineage(lg.projects(t.project_log(spark, d), _courses(spark, d), t.PROJECT_ORDER))


def _work(spark, d, enrolled, project_table):
    known = project_table.select("course", "project", F.col("seq").alias("open_from"))
    return (
        lg.enrolled_only(t.work_log(spark, d), enrolled)
        .join(known, ["course", "project"])
        .filter(F.col("seq") >= F.col("open_from"))
        .drop("open_from")
    )


def _votes(spark, d, guarded=False):
    enrolled, projects = _enrolments(spark, d), _projects(spark, d)
    return lg.grade_state(
        _work(spark, d, enrolled, projects), lg.grade_cells(enrolled, projects), t.WORK_ORDER, guarded
    )


RUN_ORDER = [*t.WORK_ORDER, "project"]


def _completions(spark, d):
    enrolled, projects = _enrolments(spark, d), _projects(spark, d)
    return lg.completions(_work(spark, d, enrolled, projects), projects, RUN_ORDER)


# -- users, courses -------------------------------------------------------------------

ULOG_SQL = f"""ulog as (select c_custkey as user_id, c_name as name, c_mktsegment as email,
   {ROLE_SQL.format('c_custkey')} as role, 0 as seq, -1 as tie from customer
   union all select o_custkey, o_orderpriority, o_orderstatus, {ROLE_SQL.format('o_custkey')},
   {DAY_SQL.format('o_orderdate')}, o_orderkey from orders),
 ustate as (select user_id, name, email, role from (select *, row_number() over
   (partition by user_id order by seq desc, tie desc) r from ulog) where r = 1)"""


def _user_state(spark, d):
    return campus.State(users=lg.user_state(t.user_log(spark, d), ["seq", "tie"]), courses=None)


@query("registered_users", _sql(ULOG_SQL, "select * from ustate"))
def registered_users(spark, d):
    return campus.registered_users(_user_state(spark, d))


@query("user_by_id", _sql(ULOG_SQL, "select * from ustate where user_id = 7"))
def user_by_id(spark, d):
    return campus.user_by_id(_user_state(spark, d), 7)


@query(
    "latest_state",
    """select o_custkey, o_orderkey, o_orderstatus from (select *, row_number() over
       (partition by o_custkey order by o_orderdate desc, o_orderkey desc) r from orders) where r = 1""",
)
def latest_state(spark, d):
    orders = t.table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return latest_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "first_wins",
    """select o_custkey, o_orderkey, o_orderstatus from (select *, row_number() over
       (partition by o_custkey order by o_orderdate, o_orderkey) r from orders) where r = 1""",
)
def first_wins(spark, d):
    orders = t.table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return first_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "role_classify",
    f"""select c_custkey, case when r in ('PROFESSOR', 'STUDENT') then r else 'ADMIN' end as stored,
       case when r = 'PROFESSOR' then r else 'STUDENT' end as registered
       from (select c_custkey, case when c_mktsegment = 'BUILDING' then c_mktsegment else {ROLE_SQL.format('c_custkey')} end as r
       from customer)""",
)
def role_classify(spark, d):
    raw = F.when(F.col("email") == "BUILDING", F.col("email")).otherwise(F.col("role"))
    return t.users(spark, d).select(
        F.col("user_id").alias("c_custkey"),
        fn.classify_role(raw).alias("stored"),
        fn.classify_role(raw, "register").alias("registered"),
    )


OFFER_SQL = f"""offers as (select case l_linenumber when 1 then 'CREATE' when 2 then 'DELETE' else 'ENROLL' end as type,
   l_suppkey as course_id, 'course ' || l_partkey as name, l_orderkey as admin_id, l_partkey as user_id,
   {DAY_SQL.format('l_shipdate')} as seq, l_orderkey as okey, l_linenumber as line, l_partkey as pkey, l_extendedprice as price
   from lineitem),
 ostate as (select c.course_id, c.name, c.admin_id, coalesce((x.seq, x.okey, x.line, x.pkey, x.price) >
     (c.seq, c.okey, c.line, c.pkey, c.price), false) as is_deleted
   from (select * from (select *, row_number() over (partition by course_id order by seq desc, okey desc, line desc, pkey desc, price desc) r
     from offers where type = 'CREATE') where r = 1) c
   left join (select * from (select *, row_number() over (partition by course_id order by seq desc, okey desc, line desc, pkey desc, price desc) r
     from offers where type = 'DELETE') where r = 1) x using (course_id))"""


def _offer_courses(spark, d):
    return lg.course_state(t.offer_log(spark, d), t.OFFER_ORDER, ["name", "admin_id"]).drop("born")


@query("course_state", _sql(OFFER_SQL, "select * from ostate"))
def course_state(spark, d):
    return _offer_courses(spark, d)


@query("live_courses", _sql(OFFER_SQL, "select course_id from ostate where not is_deleted"))
def live_courses(spark, d):
    return lg.live(_offer_courses(spark, d)).select("course_id")


@query("registered_courses", _sql(OFFER_SQL, "select course_id, name, admin_id from ostate where not is_deleted"))
def registered_courses(spark, d):
    return campus.registered_courses(campus.State(users=None, courses=_offer_courses(spark, d)))


@query(
    "course_incarnations",
    _sql(
        OFFER_SQL,
        """select course_id, seq, okey, line, type, sum((type = 'CREATE')::int) over (partition by course_id
        order by seq, okey, line, pkey, price rows unbounded preceding)::bigint as incarnation from offers""",
    ),
)
def course_incarnations(spark, d):
    out = lg.incarnations(t.offer_log(spark, d), t.OFFER_ORDER)
    return out.select("course_id", "seq", "okey", "line", "type", "incarnation")


@query(
    "dispatch_by_type",
    _sql(OFFER_SQL, "select type, course_id, count(*) as n, min(seq) as first_seq from offers group by 1, 2"),
)
def dispatch_by_type(spark, d):
    typed = lg.by_type(t.offer_log(spark, d))
    parts = [
        typed[kind]
        .groupBy("course_id")
        .agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
        .select(F.lit(kind).alias("type"), "course_id", "n", "first_seq")
        for kind in ("CREATE", "DELETE", "ENROLL")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "event_log_union",
    _sql(
        ULOG_SQL + ", " + OFFER_SQL,
        """select topic, count(*) as n, count(user_id) as with_user, count(course_id) as with_course from (
        select 'users' as topic, user_id, null as course_id from ulog
        union all select 'courses', user_id, course_id from offers) group by 1""",
    ),
)
def event_log_union(spark, d):
    log = lg.union_logs(
        t.user_log(spark, d).withColumn("topic", F.lit("users")),
        t.offer_log(spark, d).withColumn("topic", F.lit("courses")),
    )
    return log.groupBy("topic").agg(
        F.count("*").alias("n"), F.count("user_id").alias("with_user"), F.count("course_id").alias("with_course")
    )


# -- enrolments, projects, grades -----------------------------------------------------


@query("enrolments", _sql(BASE_SQL, "select student, course, since from enrol"))
def enrolments(spark, d):
    return _enrolments(spark, d).select("student", "course", "since")


@query("course_projects", _sql(BASE_SQL, "select course, project, seq, prof_id from proj"))
def course_projects(spark, d):
    out = lg.projects(t.project_log(spark, d), _courses(spark, d), t.PROJECT_ORDER)
    return out.select("course", "project", "seq", "prof_id")


@query("evaluation_seed", _sql(BASE_SQL, "select student, course, project, -2 as vote from cells"))
def evaluation_seed(spark, d):
    return lg.grade_cells(_enrolments(spark, d), _projects(spark, d))


@query(
    "command_semi_join",
    _sql(
        BASE_SQL,
        """select type, student, course, project, seq, grade from allwork
        where (student, course) in (select student, course from enrol)""",
    ),
)
def command_semi_join(spark, d):
    return lg.enrolled_only(t.work_log(spark, d), _enrolments(spark, d)).select(
        "type", "student", "course", "project", "seq", "grade"
    )


@query(
    "late_dimension_join",
    f"""select l_orderkey, l_linenumber, l_suppkey, o_custkey, o_orderkey is not null as resolved
    from lineitem left join orders on l_orderkey = o_orderkey and o_orderdate <= l_shipdate + interval 30 days""",
)
def late_dimension_join(spark, d):
    facts = t.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    dims = t.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    out = lg.await_join(facts, dims, ["l_orderkey"], "l_shipdate", "o_orderdate", "30 days")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "o_custkey", "resolved")


@query("grade_state", _sql(VOTE_SQL.replace("{pick}", "max"), "select * from votes"))
def grade_state(spark, d):
    return _votes(spark, d)


@query("grade_state_guarded", _sql(VOTE_SQL.replace("{pick}", "min"), "select * from votes"))
def grade_state_guarded(spark, d):
    return _votes(spark, d, guarded=True)


@query(
    "submission_status",
    _sql(
        VOTE_SQL.replace("{pick}", "max"),
        """select student, course, project, case vote when -2 then 'not submitted' when -1 then 'awaiting evaluation'
        else 'rating: ' || vote end as status from votes""",
    ),
)
def submission_status(spark, d):
    return _votes(spark, d).select(*lg.CELL, fn.vote_status("vote").alias("status"))


@query(
    "grade_history",
    _sql(HISTORY_SQL, "select student, course, project, seq, type, old_vote, new_vote from hist"),
)
def grade_history(spark, d):
    enrolled, projects = _enrolments(spark, d), _projects(spark, d)
    out = lg.grade_history(_work(spark, d, enrolled, projects), t.WORK_ORDER)
    return out.select(*lg.CELL, "seq", "type", "old_vote", "new_vote")


@query("course_completions", _sql(DONE_SQL, "select student, course, done_at from done"))
def course_completions(spark, d):
    return _completions(spark, d)


@query(
    "relational_division",
    _sql(
        VOTE_SQL.replace("{pick}", "max"),
        "select student, course from votes group by 1, 2 having bool_and(vote >= 18)",
    ),
)
def relational_division(spark, d):
    enrolled, projects = _enrolments(spark, d), _projects(spark, d)
    votes = lg.grade_state(
        _work(spark, d, enrolled, projects), lg.grade_cells(enrolled, projects), t.WORK_ORDER
    )
    return lg.completed(votes, projects, enrolled)


# Pages are small here, so that even small tables have several.
PAGE_ROWS = 100
PAGE_SQL = f"((row_number() over (partition by {{0}} order by {{1}}) - 1) // {PAGE_ROWS})::int as page"


@query(
    "evaluation_map",
    _sql(
        VOTE_SQL.replace("{pick}", "max"),
        f"""select course, project, page, string_agg(student || '=' || vote, ',' order by student::varchar) as votes
        from (select *, {PAGE_SQL.format('course, project', 'student::varchar')} from votes) group by 1, 2, 3""",
    ),
)
def evaluation_map(spark, d):
    text = F.transform(F.map_entries("votes"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return lg.evaluation_map(cut_lineage(_votes(spark, d)), PAGE_ROWS).select("course", "project", "page", F.array_join(text, ",").alias("votes"))


@query(
    "completed_map",
    _sql(
        DONE_SQL,
        f"""select student, page, string_agg(course, ',' order by course) as courses
        from (select *, {PAGE_SQL.format('student', 'course')} from done) group by 1, 2""",
    ),
)
def completed_map(spark, d):
    return lg.completed_map(cut_lineage(_completions(spark, d)), PAGE_ROWS).withColumn("courses", F.array_join("courses", ","))


@query(
    "course_rosters",
    _sql(
        BASE_SQL,
        f"""select course, page, s as students, p as projects from
        (select course, page, string_agg(student::varchar, ',' order by student) as s
          from (select *, {PAGE_SQL.format('course', 'student')} from enrol) group by 1, 2) full join
        (select course, page, string_agg(project, ',' order by project) as p
          from (select *, {PAGE_SQL.format('course', 'project')} from proj) group by 1, 2) using (course, page)""",
    ),
)
def course_rosters(spark, d):
    out = lg.rosters(cut_lineage(_enrolments(spark, d)), _projects(spark, d), PAGE_ROWS)
    return out.select(
        "course",
        "page",
        F.array_join(F.col("students").cast("array<string>"), ",").alias("students"),
        F.array_join("projects", ",").alias("projects"),
    )


# -- courses deleted and made anew ----------------------------------------------------
# Every year each course is deleted and made again at its first order, and the one without a
# priority is deleted for good at its last.

LIFE_SQL = f"""students as (select c_custkey as student from customer where {ROLE_SQL.format('c_custkey')} = 'STUDENT'),
 log as (select o_orderpriority as c, {DAY_SQL.format('o_orderdate')} as seq, year(o_orderdate) as y, o_custkey as student from orders),
 life as (select c, 'DELETE' as type, min(seq) as seq, -2 as rank from log group by c, y
   union all select c, 'CREATE', min(seq), -1 from log group by c, y
   union all select c, 'DELETE', max(seq), 9 from log where contains(c, 'NOT') group by c),
 lives as (select c, type, (seq, rank) as a, lead((seq, rank)) over w as b, row_number() over w as turn
   from life window w as (partition by c order by seq, rank)),
 open as (select c, a, b, c || '#' || turn as course from lives where type = 'CREATE' and {{which}}),
 enrol as (select student, course, min(seq) as since from log join open using (c)
   where (seq, 0) > a and (b is null or (seq, 0) < b) and student in (select student from students) group by 1, 2),
 lines as (select l_returnflag as project, l_suppkey * 10 as prof_id, o_orderpriority as c, o_custkey as student,
   {DAY_SQL.format('l_shipdate')} as seq, (l_linestatus = 'O')::int as rank, l_quantity::int as grade,
   {DAY_SQL.format('l_shipdate')} + case l_returnflag when 'A' then 0 when 'N' then 400 else 800 end as made
   from lineitem join orders on l_orderkey = o_orderkey),
 proj as (select course, project, made as seq, prof_id from (select *, row_number() over (partition by course, project order by made, prof_id) r
   from lines join open using (c) where (made, 0) > a and (b is null or (made, 0) < b)) where r = 1),
 cells as (select student, course, project from enrol join proj using (course)),
 work as (select case rank when 1 then 'SUBMIT' else 'RATE' end as type, w.student, course, w.project, w.seq, rank, grade
   from lines w join open using (c) join enrol using (student, course) join proj p using (course, project)
   where (w.seq, rank) > a and (b is null or (w.seq, rank) < b) and w.seq >= p.seq)"""
NOW_SQL = LIFE_SQL.replace("{which}", "b is null")
EVER_SQL = LIFE_SQL.replace("{which}", "true")
LIFE_ORDER = ["seq", "rank"]


def _ranked(log):
    return log.withColumn("rank", F.lit(0))


def _life_courses(spark, d):
    return lg.course_state(t.course_life(spark, d), LIFE_ORDER)


def _life_state(spark, d):
    courses = cut_lineage(_life_courses(spark, d))
    enrolled = lg.enrolments(_ranked(t.enrol_log(spark, d)), t.users(spark, d), courses)
    return courses, enrolled, cut_lineage(lg.projects(_ranked(t.project_log(spark, d)), courses, t.PROJECT_ORDER))


REBORN_ENROLMENTS_SQL = _sql(NOW_SQL, "select student, split_part(course, '#', 1) as course, since from enrol")


@query("reborn_enrolments", REBORN_ENROLMENTS_SQL)
def reborn_enrolments(spark, d):
    enrolled = lg.enrolments(_ranked(t.enrol_log(spark, d)), t.users(spark, d), _life_courses(spark, d))
    return enrolled.select("student", "course", "since")


@query("reborn_projects", _sql(NOW_SQL, "select split_part(course, '#', 1) as course, project, seq, prof_id from proj"))
def reborn_projects(spark, d):
    out = lg.projects(_ranked(t.project_log(spark, d)), _life_courses(spark, d), t.PROJECT_ORDER)
    return out.select("course", "project", "seq", "prof_id")


REBORN_GRADES_SQL = _sql(
    NOW_SQL + VOTE_SQL.removeprefix(BASE_SQL).replace("{pick}", "max"),
    "select student, split_part(course, '#', 1) as course, project, vote from votes",
)


@query("reborn_grade_state", REBORN_GRADES_SQL)
def reborn_grade_state(spark, d):
    courses, enrolled, projects = _life_state(spark, d)
    known = projects.select("course", "project", F.col("seq").alias("open_from"))
    events = lg.enrolled_only(lg.of_current(t.work_log(spark, d), courses), enrolled).join(known, ["course", "project"])
    return lg.grade_state(events.filter(F.col("seq") >= F.col("open_from")), lg.grade_cells(enrolled, projects), t.WORK_ORDER)


REBORN_HISTORY_SQL = _sql(
    EVER_SQL + HISTORY_SQL.removeprefix(BASE_SQL),
    "select student, split_part(course, '#', 1) as course, project, seq, type, old_vote, new_vote from hist",
)
REBORN_COMPLETIONS_SQL = _sql(
    EVER_SQL + DONE_SQL.removeprefix(BASE_SQL),
    "select student, split_part(course, '#', 1) as course, min(done_at) as done_at from done group by 1, 2",
)


@query("reborn_completions", REBORN_COMPLETIONS_SQL)
def reborn_completions(spark, d):
    """Passes count within one incarnation; a completion outlives it."""
    life = cut_lineage(t.course_life(spark, d).withColumnRenamed("course_id", "course"))

    def tagged(log):
        return lg.by_incarnation(log, life, LIFE_ORDER)

    wanted = t.enrol_log(spark, d).select(F.col("user_id").alias("student"), F.col("course_id").alias("course"), "seq")
    students = t.users(spark, d).filter("role = 'STUDENT'").select(F.col("user_id").alias("student"))
    enrolled = tagged(_ranked(wanted.join(students, "student", "left_semi"))).select("student", "course", "incarnation").distinct()
    first = first_per_key(tagged(_ranked(t.project_log(spark, d))), ["course", "incarnation", "project"], t.PROJECT_ORDER)
    projects = cut_lineage(first.select("course", "incarnation", "project", "seq"))
    known = projects.withColumnRenamed("seq", "open_from")
    events = (
        tagged(t.work_log(spark, d))
        .join(enrolled, ["student", "course", "incarnation"], "left_semi")
        .join(known, ["course", "incarnation", "project"])
        .filter(F.col("seq") >= F.col("open_from"))
        .drop("open_from")
    )
    return lg.completions(events, projects, RUN_ORDER)


# -- read queries ---------------------------------------------------------------------

STATUS_SQL = (
    DONE_SQL
    + """, status as (select student, e.course, c.name, c.admin_id, case when d.done_at is null then 'NOT COMPLETED' else 'COMPLETED' end as status
   from enrol e join courses c on e.course = c.course_id and not is_deleted left join done d using (student, course))"""
)


def _reading_state(spark, d):
    return campus.State(
        users=t.users(spark, d),
        courses=_courses(spark, d),
        enrolments=_enrolments(spark, d),
        completions=_completions(spark, d),
    )


@query("student_course_status", _sql(STATUS_SQL, "select student, course, name, admin_id, status from status"))
def student_course_status(spark, d):
    return campus.student_courses(_reading_state(spark, d)).select("student", "course", "name", "admin_id", "status")


@query(
    "student_courses",
    _sql(
        STATUS_SQL,
        """select student, '{' || string_agg('"' || course || '":{"course":"' || course || '","name":"' || name ||
        '","status":"' || status || '"}', ',' order by course) || '}' as json from status group by 1""",
    ),
)
def student_courses(spark, d):
    return campus.student_courses_json(_reading_state(spark, d))


@query("projects_of_course", _sql(BASE_SQL, "select course, project, prof_id from proj"))
def projects_of_course(spark, d):
    state = campus.State(users=None, courses=_courses(spark, d), projects=_projects(spark, d))
    return campus.projects_of_course(state)


@query(
    "json_build",
    """select c_custkey, '{"userId":' || c_custkey || ',"name":"' || c_name || '","segment":"' || c_mktsegment || '"}' as json
       from customer""",
)
def json_build(spark, d):
    json = fn.json_object(["c_custkey", "c_name", "c_mktsegment"], ["userId", "name", "segment"])
    return t.table(spark, d, "customer").select("c_custkey", json.alias("json"))


@query(
    "split_join",
    """select c_custkey, c_custkey || ',' || c_name || ',' || c_mktsegment as line, c_name as second from customer""",
)
def split_join(spark, d):
    line = fn.join_fields("c_custkey", "c_name", "c_mktsegment")
    return t.table(spark, d, "customer").select("c_custkey", line.alias("line")).select(
        "c_custkey", "line", fn.split_fields("line", ["first", "second"])[1]
    )


@query(
    "bool_parse",
    "select l_orderkey, l_linenumber, l_linestatus = 'F' as flag from lineitem",
)
def bool_parse(spark, d):
    text = F.when(F.col("l_linestatus") == "F", "TRUE").otherwise("yes")
    return t.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", fn.parse_bool(text).alias("flag"))


# -- admission checks -----------------------------------------------------------------
# State: what was known before 1998 (courses priority-status for F and O orders, one priority
# deleted; projects A and N of each course). Commands: all customers, orders and lines.

ADMIT_SQL = f"""users as (select c_custkey as user_id, {ROLE_SQL.format('c_custkey')} as role from customer),
 vc as (select distinct o_orderpriority || '-' || o_orderstatus as course from orders
   where o_orderstatus in ('F', 'O') and not contains(o_orderpriority, 'NOT')),
 ve as (select distinct o_custkey as student, o_orderpriority || '-' || o_orderstatus as course from orders
   where o_orderdate < timestamp '1998-01-01'),
 lines as (select o_custkey as student, o_orderpriority || '-' || o_orderstatus as course, l_returnflag as project,
   l_suppkey * 10 as prof_id, l_linestatus as st, l_quantity::int as q, l_shipdate as sd, l_orderkey, l_linenumber
   from lineitem join orders on l_orderkey = o_orderkey),
 vp as (select course, project, min(prof_id) as prof_id from lines where project in ('A', 'N') group by 1, 2),
 vv as (select student, course, project, (case when count(*) filter (st = 'O') = 0 then -2
   when count(*) filter (st = 'F') = 0 then -1 else max(q) end)::int as vote
   from lines where sd < timestamp '1998-01-01' group by 1, 2, 3),
 vd as (select distinct student, course from lines where q = 50),
 cmd as (select l_orderkey, l_linenumber, lines.prof_id, lines.student, lines.course, lines.project, u.role as role, ur.role as prof_role,
   vc.course is not null as has_course, ve.course is not null as is_enrolled, vd.course is not null as is_done,
   vp.course is not null as has_project, vp.prof_id as owner, coalesce(vv.vote, -2) as vote
   from lines left join users u on u.user_id = lines.student left join users ur on ur.user_id = lines.prof_id
   left join vc on vc.course = lines.course left join ve on ve.student = lines.student and ve.course = lines.course
   left join vd on vd.student = lines.student and vd.course = lines.course
   left join vp on vp.course = lines.course and vp.project = lines.project
   left join vv on vv.student = lines.student and vv.course = lines.course and vv.project = lines.project)"""

ORDER_CMD_SQL = ADMIT_SQL + """, oc as (select o_orderkey, o_custkey as actor, o_orderpriority || '-' || o_orderstatus as course, role,
   vc.course is not null as has_course, ve.course is not null as is_enrolled from orders
   left join users on user_id = o_custkey left join vc on vc.course = o_orderpriority || '-' || o_orderstatus
   left join ve on ve.student = o_custkey and ve.course = o_orderpriority || '-' || o_orderstatus)"""


def _course_name():
    return F.concat_ws("-", "o_orderpriority", "o_orderstatus")


def _lines(spark, d):
    return t._order_lines(spark, d, "l_linenumber", "l_suppkey", "l_linestatus", "l_quantity", "l_shipdate").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_suppkey") * 10).alias("prof_id"),
        F.col("o_custkey").alias("student"),
        _course_name().alias("course"),
        F.col("l_returnflag").alias("project"),
        F.col("l_linestatus").alias("st"),
        F.col("l_quantity").cast("int").alias("q"),
        F.col("l_shipdate").alias("sd"),
    )


def _admission_state(spark, d, deep: bool = False) -> campus.State:
    orders = t.table(spark, d, "orders")
    courses = (
        orders.filter(F.col("o_orderstatus").isin("F", "O"))
        .select(_course_name().alias("course_id"), F.col("o_orderpriority").contains("NOT").alias("is_deleted"))
        .distinct()
    )
    before = F.lit("1998-01-01").cast("timestamp_ntz")
    enrolled = (
        orders.filter(F.col("o_orderdate") < before)
        .select(F.col("o_custkey").alias("student"), _course_name().alias("course"))
        .distinct()
    )
    if not deep:
        return campus.State(users=t.users(spark, d), courses=courses, enrolments=enrolled)
    lines = _lines(spark, d)
    projects = (
        lines.filter(F.col("project").isin("A", "N")).groupBy("course", "project").agg(F.min("prof_id").alias("prof_id"))
    )
    opened, finished = F.count_if(F.col("st") == "O"), F.count_if(F.col("st") == "F")
    votes = (
        lines.filter(F.col("sd") < before)
        .groupBy("student", "course", "project")
        .agg(F.when(opened == 0, -2).when(finished == 0, -1).otherwise(F.max("q")).alias("vote"))
    )
    done = lines.filter("q = 50").select("student", "course").distinct()
    return campus.State(
        users=t.users(spark, d),
        courses=courses,
        enrolments=enrolled,
        projects=cut_lineage(projects),
        votes=votes,
        completions=done,
    )


def _order_commands(spark, d):
    return t.table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("actor"), _course_name().alias("course"))


@query(
    "admit_register",
    """select c_custkey as user_id, case when c_acctbal >= 0 then 'user already registered' end as reason from customer""",
)
def admit_register(spark, d):
    customer = t.table(spark, d, "customer")
    known = campus.State(users=customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("user_id")), courses=None)
    return campus.admit_register(customer.select(F.col("c_custkey").alias("user_id")), known)


@query(
    "admit_create_course",
    _sql(
        ORDER_CMD_SQL,
        """select o_orderkey, actor, course, case when role <> 'ADMIN' then 'not an admin'
        when has_course then 'course already exists' end as reason from oc""",
    ),
)
def admit_create_course(spark, d):
    return campus.admit_create_course(_order_commands(spark, d), _admission_state(spark, d))


@query(
    "admit_delete_course",
    _sql(
        ORDER_CMD_SQL,
        """select o_orderkey, actor, course, case when role <> 'ADMIN' then 'not an admin'
        when not has_course then 'course does not exist' end as reason from oc""",
    ),
)
def admit_delete_course(spark, d):
    return campus.admit_delete_course(_order_commands(spark, d), _admission_state(spark, d))


@query(
    "admit_enrol",
    _sql(
        ORDER_CMD_SQL,
        """select o_orderkey, actor, course, case when role <> 'STUDENT' then 'not a student'
        when not has_course then 'course does not exist' when is_enrolled then 'student already enrolled' end as reason from oc""",
    ),
)
def admit_enrol(spark, d):
    return campus.admit_enrol(_order_commands(spark, d), _admission_state(spark, d))


@query(
    "admit_create_project",
    _sql(
        ADMIT_SQL,
        """select l_orderkey, l_linenumber, prof_id as actor, course, project, case when prof_role is distinct from 'PROFESSOR'
        then 'not a professor' when not has_course then 'course does not exist' when has_project then 'project already exists'
        end as reason from cmd""",
    ),
)
def admit_create_project(spark, d):
    cmds = _lines(spark, d).select("l_orderkey", "l_linenumber", F.col("prof_id").alias("actor"), "course", "project")
    return campus.admit_create_project(cmds, _admission_state(spark, d, deep=True))


@query(
    "admit_submit",
    _sql(
        ADMIT_SQL,
        """select l_orderkey, l_linenumber, student as actor, course, project, case when role <> 'STUDENT' then 'not a student'
        when not has_course then 'course does not exist' when not is_enrolled then 'student not enrolled'
        when is_done then 'course already completed' when not has_project then 'project does not exist'
        when vote <> -2 then 'project already submitted' end as reason from cmd""",
    ),
)
def admit_submit(spark, d):
    cmds = _lines(spark, d).select("l_orderkey", "l_linenumber", F.col("student").alias("actor"), "course", "project")
    return campus.admit_submit(cmds, _admission_state(spark, d, deep=True))


@query(
    "admit_rate",
    _sql(
        ADMIT_SQL,
        """select l_orderkey, l_linenumber, prof_id as actor, student, course, project, case
        when prof_role is distinct from 'PROFESSOR' then 'not a professor' when role <> 'STUDENT' then 'student does not exist'
        when not has_course then 'course does not exist' when not is_enrolled then 'student not enrolled'
        when not has_project then 'project does not exist' when owner <> prof_id then 'project of another professor'
        when vote = -2 then 'project not submitted' when vote <> -1 then 'project already rated' end as reason from cmd""",
    ),
)
def admit_rate(spark, d):
    cmds = _lines(spark, d).select(
        "l_orderkey", "l_linenumber", F.col("prof_id").alias("actor"), "student", "course", "project"
    )
    return campus.admit_rate(cmds, _admission_state(spark, d, deep=True))


@query(
    "project_check",
    _sql(
        ADMIT_SQL,
        """select l_orderkey, l_linenumber, student, course, project, case when not has_course then 'course does not exist'
        when not is_enrolled then 'student not enrolled' when not has_project then 'project does not exist'
        when vote = -2 then 'not submitted' when vote = -1 then 'awaiting evaluation' else 'rating: ' || vote end as answer from cmd""",
    ),
)
def project_check(spark, d):
    requests = _lines(spark, d).select("l_orderkey", "l_linenumber", "student", "course", "project")
    return campus.project_check(_admission_state(spark, d, deep=True), requests)
