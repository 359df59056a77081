"""State tables folded from an ordered event log.

Log rows: type, seq and the ids the type needs. ``order`` names the columns that give the
log one total order per key. Tables: users(user_id, ..., role), courses(course_id, ...,
is_deleted), enrolments(student, course), projects(course, project, prof_id, seq),
votes(student, course, project, vote), completions(student, course).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystream.functions.scalars import NOT_SUBMITTED, PASS_GRADE, SUBMITTED, classify_role
from tallystream.operators.ordered import (
    HOT_ROWS,
    SLICE,
    first_per_key,
    latest_per_key,
    number_rows,
    previous_in_slices,
    running_in_slices,
    running_sum,
    slice_by_order,
)
from tallystream.operators.sizing import BROADCAST_ROWS, broadcast_if_small
from tallystream.session import cut_lineage

CELL = ["student", "course", "project"]
FEW_TURNS = 64


# -- log ------------------------------------------------------------------------------


def union_logs(*logs: DataFrame) -> DataFrame:
    """Several topics as one log; columns a topic lacks are null."""
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log, allowMissingColumns=True)
    return out


# Event types and the columns each of them carries.
EVENT_COLUMNS = {
    "CREATE": ("course_id", "name", "admin_id"),
    "DELETE": ("course_id",),
    "ENROLL": ("user_id", "course_id"),
    "COMPLETE": ("user_id", "course_id", "project_id"),
    "SUBMIT": ("user_id", "course_id", "project_id", "attachment"),
    "RATE": ("user_id", "course_id", "project_id", "grade"),
    "UPDATEMAP": ("user_id", "course_id", "project_id"),
}


def by_type(log: DataFrame) -> dict[str, DataFrame]:
    """One typed table per event type; rows of other types are ignored."""
    return {
        kind: log.filter(F.col("type") == kind).select(
            "seq", *[c for c in columns if c in log.columns]
        )
        for kind, columns in EVENT_COLUMNS.items()
    }


# -- users and courses ----------------------------------------------------------------


def user_state(log: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Last registration per user; unknown roles count as ADMIN."""
    return latest_per_key(log, "user_id", order).withColumn("role", classify_role("role"))


def course_state(log: DataFrame, order: Sequence[str] = ("seq",), payload: Sequence[str] = ()) -> DataFrame:
    """Current course per id: the last CREATE, deleted if a DELETE came after it.

    ``born`` holds the order columns of that CREATE: what came before it belongs to an earlier
    course of the same id.
    """
    at = F.struct(*order)
    created, deleted = F.col("type") == "CREATE", F.col("type") == "DELETE"
    return (
        log.groupBy("course_id")
        .agg(
            F.max(F.when(created, F.struct(at.alias("at"), *payload))).alias("made"),
            F.max(F.when(deleted, at)).alias("gone"),
        )
        .filter(F.col("made").isNotNull())
        .select(
            "course_id",
            *[F.col(f"made.{c}").alias(c) for c in payload],
            F.coalesce(F.col("gone") > F.col("made.at"), F.lit(False)).alias("is_deleted"),
            F.col("made.at").alias("born"),
        )
    )


def live(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_deleted"))


def incarnations(log: DataFrame, order: Sequence[str] = ("seq",), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number of the course object each event meets: every CREATE starts a new, empty one.

    0 means the event came before any CREATE.
    """
    made = F.when(F.col("type") == "CREATE", 1).otherwise(0)
    return running_sum(log, "course_id", order, made, "incarnation", hot_rows)


def of_current(events: DataFrame, courses: DataFrame, course: str = "course") -> DataFrame:
    """Events that meet the live course as it is now: those after its last CREATE.

    ``events`` have the columns of ``born``. A course table without ``born`` has one course
    per id for all time.
    """
    open_courses = live(courses).select(F.col("course_id").alias("__course"), *[c for c in ("born",) if c in courses.columns])
    met = F.col(course) == F.col("__course")
    if "born" in courses.columns:
        met = met & (F.struct(*courses.schema["born"].dataType.names) > F.col("born"))
    return events.join(broadcast_if_small(open_courses), met, "left_semi")


def by_incarnation(
    events: DataFrame, log: DataFrame, order: Sequence[str], course: str = "course", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Events with ``incarnation``, the course object they met; events that met none are left out.

    ``log`` has the CREATE and DELETE events (``course``, ``type`` and the ``order`` columns).
    Each of them ends what was before, and a CREATE begins a new, empty course, so the running
    count of both is the number of the object. Where a course has at most ``FEW_TURNS`` of them and all
    fit a broadcast, events stay where they are and look up the span of the order they are in.
    """
    turns = log.filter(F.col("type").isin("CREATE", "DELETE")).select(course, "type", *order)
    most, all_ = turns.groupBy(course).count().agg(F.max("count"), F.sum("count")).first()
    if not all_ or (most <= FEW_TURNS and all_ <= BROADCAST_ROWS):
        at, along = F.struct(*order), Window.partitionBy(course).orderBy(*order)
        spans = turns.select(
            F.col(course).alias("__course"), "type", at.alias("__from"), F.lead(at).over(along).alias("__to"),
            F.row_number().over(along).cast("long").alias("incarnation"),
        ).filter(F.col("type") == "CREATE").drop("type")
        met = (F.col(course) == F.col("__course")) & (at >= F.col("__from")) & (F.col("__to").isNull() | (at < F.col("__to")))
        return events.join(F.broadcast(spans), met).drop("__course", "__from", "__to")
    numbered = number_rows(turns, course, order, "__turn", hot_rows)
    created = numbered.filter(F.col("type") == "CREATE").select(course, (F.col("__turn") + 1).alias("incarnation"))
    marked = events.withColumn("__turn", F.lit(0)).unionByName(
        turns.select(course, *order, F.lit(1).alias("__turn")), allowMissingColumns=True
    )
    counted = running_sum(marked, course, order, F.col("__turn"), "incarnation", hot_rows)
    return counted.filter(F.col("__turn") == 0).drop("__turn").join(created, [course, "incarnation"], "left_semi")


# -- enrolments, projects, cells ------------------------------------------------------


def enrolments(log: DataFrame, users: DataFrame, courses: DataFrame) -> DataFrame:
    """(student, course, since): ENROLL events of students to live courses, first one counts.

    A course made anew has none of the students of the one before.
    """
    wanted = of_current(log, courses, "course_id").groupBy(F.col("user_id").alias("student"), F.col("course_id").alias("course")).agg(
        F.min("seq").alias("since")
    )
    students = users.filter(F.col("role") == "STUDENT").select(F.col("user_id").alias("student"))
    return wanted.join(students, "student", "left_semi")


def projects(log: DataFrame, courses: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """First definition of each project of an existing course, as that course is now."""
    return first_per_key(of_current(log, courses), ["course", "project"], order)


def grade_cells(enrolled: DataFrame, project_table: DataFrame) -> DataFrame:
    """One unsubmitted (student, course, project) cell per enrolment and project of the course.

    Cells are made both when a project appears and when a student enrols later, so the set
    is the same in whatever order these come.
    """
    known = broadcast_if_small(project_table.select("course", "project"))
    return enrolled.select("student", "course").join(known, "course").withColumn("vote", F.lit(NOT_SUBMITTED))


def enrolled_only(events: DataFrame, enrolled: DataFrame) -> DataFrame:
    """Events whose student is enrolled in the course."""
    return events.join(enrolled.select("student", "course"), ["student", "course"], "left_semi")


def await_join(
    facts: DataFrame, dims: DataFrame, on: Sequence[str], fact_ts: str, dim_ts: str, within: str
) -> DataFrame:
    """Facts with the row they refer to, where that appears no later than ``within`` after
    the fact; ``resolved`` is false for the others. In a batch the order of arrival has no
    effect."""
    dim_columns = [c for c in dims.columns if c not in on]
    key = dims.select(*[F.col(c).alias(f"__{c}") for c in on], *dim_columns)
    match = F.col(dim_ts) <= F.col(fact_ts) + F.expr(f"interval {within}")
    for c in on:
        match = match & (F.col(c) == F.col(f"__{c}"))
    return (
        facts.join(key, match, "left")
        .withColumn("resolved", F.col(f"__{on[0]}").isNotNull())
        .drop(*[f"__{c}" for c in on])
    )


# -- grades ---------------------------------------------------------------------------


def grade_state(
    events: DataFrame, cells: DataFrame, order: Sequence[str] = ("seq",), guarded: bool = False
) -> DataFrame:
    """Vote per cell after all SUBMIT and RATE events.

    A SUBMIT sets the cell to submitted; the first RATE after it sets the grade; other RATEs
    have no effect. So only the last SUBMIT and the first RATE after it matter. With
    ``guarded`` a cell takes one submission only, the first.
    """
    at = F.struct(*order)
    pick = F.min if guarded else F.max
    submitted = (
        events.filter(F.col("type") == "SUBMIT").groupBy(*CELL).agg(pick(at).alias("handed_in"))
    )
    rated = (
        events.filter(F.col("type") == "RATE")
        .join(submitted, CELL)
        .filter(at > F.col("handed_in"))
        .groupBy(*CELL)
        .agg(F.min_by("grade", at).alias("grade"))
    )
    return (
        cells.select(*CELL)
        .join(submitted, CELL, "left")
        .join(rated, CELL, "left")
        .select(
            *CELL,
            F.when(F.col("handed_in").isNull(), NOT_SUBMITTED)
            .otherwise(F.coalesce("grade", F.lit(SUBMITTED)))
            .cast("int")
            .alias("vote"),
        )
    )


def _history(events: DataFrame, order: Sequence[str], hot_rows: int) -> tuple[DataFrame, bool]:
    events = cut_lineage(events)  # counted, then folded
    sliced, many = slice_by_order(events, ["student", "course"], order, hot_rows)
    if not many:
        sliced = sliced.repartition("student", "course")  # serves all windows
    told = previous_in_slices(sliced, many, CELL, order, {"__before": F.col("type")})
    # after a SUBMIT the next RATE counts, every further one finds the cell rated
    counted = told.filter(
        (F.col("type") == "SUBMIT") | ((F.col("type") == "RATE") & (F.col("__before") == "SUBMIT"))
    )
    after = F.when(F.col("type") == "SUBMIT", F.lit(SUBMITTED)).otherwise(F.col("grade").cast("int"))
    moved = counted.withColumn("new_vote", after).drop("__before")
    told = previous_in_slices(moved, many, CELL, order, {"old_vote": F.col("new_vote")})
    return told.withColumn("old_vote", F.coalesce("old_vote", F.lit(NOT_SUBMITTED))), many


def grade_history(
    events: DataFrame, order: Sequence[str] = ("seq",), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every change of a cell with the vote before and after it (grades are >= 0)."""
    return _history(events, order, hot_rows)[0].drop(SLICE)


def completions(
    events: DataFrame, project_table: DataFrame, order: Sequence[str] = ("seq",), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(student, course, done_at): the first accepted rating after which the student has passed
    every project the course had by then. Later projects or submissions do not revoke it.
    With ``incarnation`` among the columns of both tables, passes and projects count within
    one incarnation, and the completion stays with the course id.

    ``order`` must begin with ``seq``, the time that is compared with the projects' ``seq``.
    """
    if "incarnation" in events.columns:
        object_ = F.struct("course", "incarnation")
        done = completions(
            events.withColumn("course", object_).drop("incarnation"),
            project_table.withColumn("course", object_).drop("incarnation"),
            order,
            hot_rows,
        )
        return done.groupBy("student", F.col("course.course").alias("course")).agg(F.min("done_at").alias("done_at"))
    history, many = _history(events, order, hot_rows)
    passed = lambda c: F.when(F.col(c) >= PASS_GRADE, 1).otherwise(0)
    counted = running_in_slices(
        history, many, ["student", "course"], order, passed("new_vote") - passed("old_vote"), "passes"
    ).drop(SLICE)
    return (
        counted.filter(F.col("type") == "RATE")
        .join(_projects_over_time(project_table), "course")
        .filter((F.col("seq") >= F.col("__from")) & (F.col("__to").isNull() | (F.col("seq") < F.col("__to"))))
        .filter(F.col("passes") == F.col("__open"))
        .groupBy("student", "course")
        .agg(F.min("seq").alias("done_at"))
    )


def _projects_over_time(project_table: DataFrame) -> DataFrame:
    """(course, __from, __to, __open): how many projects a course has in each span of time."""
    along = Window.partitionBy("course").orderBy("seq")
    per_time = project_table.groupBy("course", "seq").agg(F.count("*").alias("n"))
    steps = per_time.select(
        "course",
        F.col("seq").alias("__from"),
        F.lead("seq").over(along).alias("__to"),
        F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("__open"),
    )
    return broadcast_if_small(steps)


def completed(votes: DataFrame, project_table: DataFrame, enrolled: DataFrame) -> DataFrame:
    """Students who passed every project of a course; a missing cell counts as unsubmitted."""
    needed = broadcast_if_small(project_table.groupBy("course").agg(F.countDistinct("project").alias("needed")))
    passed = (
        votes.filter(F.col("vote") >= PASS_GRADE)
        .join(broadcast_if_small(project_table.select("course", "project").distinct()), ["course", "project"], "left_semi")
        .groupBy("student", "course")
        .agg(F.countDistinct("project").alias("passed"))
    )
    return (
        passed.join(needed, "course")
        .filter(F.col("passed") == F.col("needed"))
        .select("student", "course")
        .join(enrolled.select("student", "course"), ["student", "course"], "left_semi")
    )


def course_status(enrolled: DataFrame, courses: DataFrame, done: DataFrame) -> DataFrame:
    """A student's live courses with COMPLETED or NOT COMPLETED."""
    flags = done.select("student", "course").distinct().withColumn("__done", F.lit(True))
    details = broadcast_if_small(live(courses).withColumnRenamed("course_id", "course").drop("is_deleted"))
    return (
        enrolled.select("student", "course")
        .join(flags, ["student", "course"], "left")
        .join(details, "course")
        .withColumn(
            "status", F.when(F.col("__done"), F.lit("COMPLETED")).otherwise(F.lit("NOT COMPLETED"))
        )
        .drop("__done")
    )


# -- collected forms ------------------------------------------------------------------
# A list or map is the result itself. It comes out in pages, one row each: entry i of the sorted
# list is on page i // page_rows, so that no value grows with the data.

PAGE_ROWS = 100_000


def paged(df: DataFrame, keys: Sequence[str], item: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Add ``page``: the number of the row, in order of ``item`` within ``keys``, by ``page_rows``."""
    numbered = number_rows(df, keys, item, "__rn")
    return numbered.withColumn("page", F.floor(F.col("__rn") / page_rows).cast("int")).drop("__rn")


def evaluation_map(votes: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(course, project, page, votes map<student, vote>), students in the order of their text."""
    entries = F.sort_array(F.collect_list(F.struct(F.col("student").alias("k"), F.col("vote").alias("v"))))
    named = votes.withColumn("student", F.col("student").cast("string"))
    return (
        paged(named, ["course", "project"], "student", page_rows)
        .groupBy("course", "project", "page")
        .agg(F.map_from_entries(entries).alias("votes"))
    )


def completed_map(done: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(student, page, courses)."""
    return _lists(done, "student", "course", "courses", page_rows)


def rosters(enrolled: DataFrame, project_table: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(course, page, students, projects)."""
    who = _lists(enrolled, "course", "student", "students", page_rows)
    what = _lists(project_table, "course", "project", "projects", page_rows)
    return who.join(what, ["course", "page"], "full")


def _lists(df: DataFrame, key: str, item: str, name: str, page_rows: int) -> DataFrame:
    once = df.select(key, item).distinct()
    listed = F.sort_array(F.collect_list(item)).alias(name)
    return paged(once, [key], item, page_rows).groupBy(key, "page").agg(listed)


def has_role(role: Column | str, wanted: str) -> Column:
    return (F.col(role) if isinstance(role, str) else role).eqNullSafe(F.lit(wanted))
