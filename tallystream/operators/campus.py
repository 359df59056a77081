"""Read queries and admission checks over the state tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallystream.functions.scalars import NOT_SUBMITTED, SUBMITTED, keyed_json, vote_status
from tallystream.operators.ledger import course_status, has_role, live
from tallystream.operators.sizing import broadcast_if_small


@dataclass(frozen=True)
class State:
    users: DataFrame
    courses: DataFrame
    enrolments: DataFrame | None = None
    projects: DataFrame | None = None
    votes: DataFrame | None = None
    completions: DataFrame | None = None


# -- read queries ---------------------------------------------------------------------


def registered_users(state: State) -> DataFrame:
    """All users; passwords are never output."""
    return state.users.select("user_id", "name", "email", "role")


def user_by_id(state: State, user_id) -> DataFrame:
    return registered_users(state).filter(F.col("user_id") == user_id)


def registered_courses(state: State) -> DataFrame:
    return live(state.courses).select("course_id", "name", "admin_id")


def student_courses(state: State, student=None) -> DataFrame:
    """Live courses of one student (of every student if none is named) with their status."""
    enrolled = state.enrolments if student is None else state.enrolments.filter(F.col("student") == student)
    return course_status(enrolled, state.courses, state.completions)


def student_courses_json(state: State) -> DataFrame:
    """One JSON object per student, keyed by course."""
    return keyed_json(
        student_courses(state), ["student"], "course", {"course": "course", "name": "name", "status": "status"}
    )


def projects_of_course(state: State, course=None) -> DataFrame:
    """Projects of a live course (of all live courses if none is named)."""
    wanted = state.projects if course is None else state.projects.filter(F.col("course") == course)
    known = live(state.courses).select(F.col("course_id").alias("course"))
    return wanted.join(known, "course", "left_semi").select("course", "project", "prof_id")


def project_check(state: State, requests: DataFrame) -> DataFrame:
    """Status of each requested (student, course, project) or why there is none."""
    seen = _with_vote(_with_project(_with_enrolment(_with_course(requests, state), state), state), state)
    answer = (
        F.when(~F.col("has_course"), F.lit("course does not exist"))
        .when(~F.col("is_enrolled"), F.lit("student not enrolled"))
        .when(~F.col("has_project"), F.lit("project does not exist"))
        .otherwise(vote_status("vote"))
    )
    return seen.select(*requests.columns, answer.alias("answer"))


# -- admission checks -----------------------------------------------------------------


def _flagged(df: DataFrame, table: DataFrame, on: dict[str, str], flag: str) -> DataFrame:
    """Left join on distinct keys that leaves one boolean column behind."""
    keys = table.select(*[F.col(t).alias(f"__{t}") for t in on.values()]).distinct()
    keys = keys.withColumn("__hit", F.lit(True))
    if table.columns == ["course_id"]:  # few courses, each with many rows on the other side
        keys = broadcast_if_small(keys)
    match = F.lit(True)
    for c, t in on.items():
        match = match & (F.col(c) == F.col(f"__{t}"))
    return (
        df.join(keys, match, "left")
        .withColumn(flag, F.col("__hit").isNotNull())
        .drop("__hit", *[f"__{t}" for t in on.values()])
    )


def _with_role(df: DataFrame, state: State, who: str, column: str) -> DataFrame:
    roles = state.users.select(F.col("user_id").alias("__who"), F.col("role").alias(column))
    return df.join(roles, F.col(who) == F.col("__who"), "left").drop("__who")


def _with_course(df: DataFrame, state: State) -> DataFrame:
    return _flagged(df, live(state.courses).select("course_id"), {"course": "course_id"}, "has_course")


def _with_enrolment(df: DataFrame, state: State, student: str = "student") -> DataFrame:
    return _flagged(df, state.enrolments, {student: "student", "course": "course"}, "is_enrolled")


def _with_project(df: DataFrame, state: State) -> DataFrame:
    table = broadcast_if_small(
        state.projects.select(
            F.col("course").alias("__c"), F.col("project").alias("__p"), F.col("prof_id").alias("owner")
        )
    )
    return (
        df.join(table, (F.col("course") == F.col("__c")) & (F.col("project") == F.col("__p")), "left")
        .withColumn("has_project", F.col("__c").isNotNull())
        .drop("__c", "__p")
    )


def _with_vote(df: DataFrame, state: State, student: str = "student") -> DataFrame:
    votes = state.votes.select(
        F.col("student").alias("__s"), F.col("course").alias("__c"), F.col("project").alias("__p"), "vote"
    )
    match = (F.col(student) == F.col("__s")) & (F.col("course") == F.col("__c")) & (F.col("project") == F.col("__p"))
    return df.join(votes, match, "left").withColumn("vote", F.coalesce("vote", F.lit(NOT_SUBMITTED))).drop(
        "__s", "__c", "__p"
    )


def admit(commands: DataFrame, checked: DataFrame, rules: Sequence[tuple[Column, str]]) -> DataFrame:
    """Commands with ``reason``: the first rule that fails, null for an accepted command.

    All commands are judged against the same state.
    """
    reason = F.lit(None).cast("string")
    for holds, text in reversed(rules):
        reason = F.when(~F.coalesce(holds, F.lit(False)), F.lit(text)).otherwise(reason)
    return checked.select(*commands.columns, reason.alias("reason"))


def split_admitted(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reason)."""
    return judged.filter(F.col("reason").isNull()).drop("reason"), judged.filter(F.col("reason").isNotNull())


def admit_register(cmds: DataFrame, state: State) -> DataFrame:
    """Commands: user_id."""
    seen = _flagged(cmds, state.users, {"user_id": "user_id"}, "known")
    return admit(cmds, seen, [(~F.col("known"), "user already registered")])


def admit_create_course(cmds: DataFrame, state: State) -> DataFrame:
    """Commands: actor, course."""
    seen = _with_course(_with_role(cmds, state, "actor", "role"), state)
    return admit(
        cmds, seen, [(has_role("role", "ADMIN"), "not an admin"), (~F.col("has_course"), "course already exists")]
    )


def admit_delete_course(cmds: DataFrame, state: State) -> DataFrame:
    """Commands: actor, course."""
    seen = _with_course(_with_role(cmds, state, "actor", "role"), state)
    return admit(
        cmds, seen, [(has_role("role", "ADMIN"), "not an admin"), (F.col("has_course"), "course does not exist")]
    )


def admit_enrol(cmds: DataFrame, state: State) -> DataFrame:
    """Commands: actor, course."""
    seen = _with_enrolment(_with_course(_with_role(cmds, state, "actor", "role"), state), state, "actor")
    return admit(
        cmds,
        seen,
        [
            (has_role("role", "STUDENT"), "not a student"),
            (F.col("has_course"), "course does not exist"),
            (~F.col("is_enrolled"), "student already enrolled"),
        ],
    )


def admit_create_project(cmds: DataFrame, state: State) -> DataFrame:
    """Commands: actor, course, project."""
    seen = _with_project(_with_course(_with_role(cmds, state, "actor", "role"), state), state)
    return admit(
        cmds,
        seen,
        [
            (has_role("role", "PROFESSOR"), "not a professor"),
            (F.col("has_course"), "course does not exist"),
            (~F.col("has_project"), "project already exists"),
        ],
    )


def admit_submit(cmds: DataFrame, state: State) -> DataFrame:
    """Commands: actor, course, project."""
    seen = _with_enrolment(_with_course(_with_role(cmds, state, "actor", "role"), state), state, "actor")
    seen = _flagged(seen, state.completions, {"actor": "student", "course": "course"}, "is_done")
    seen = _with_vote(_with_project(seen, state), state, "actor")
    return admit(
        cmds,
        seen,
        [
            (has_role("role", "STUDENT"), "not a student"),
            (F.col("has_course"), "course does not exist"),
            (F.col("is_enrolled"), "student not enrolled"),
            (~F.col("is_done"), "course already completed"),
            (F.col("has_project"), "project does not exist"),
            (F.col("vote") == NOT_SUBMITTED, "project already submitted"),
        ],
    )


def admit_rate(cmds: DataFrame, state: State, grades: tuple[int, int] | None = None) -> DataFrame:
    """Commands: actor, student, course, project (and grade if a range ``grades`` is set)."""
    seen = _with_role(_with_role(cmds, state, "actor", "role"), state, "student", "student_role")
    seen = _with_project(_with_enrolment(_with_course(seen, state), state), state)
    seen = _with_vote(seen, state)
    rules = [
        (has_role("role", "PROFESSOR"), "not a professor"),
        (has_role("student_role", "STUDENT"), "student does not exist"),
        (F.col("has_course"), "course does not exist"),
        (F.col("is_enrolled"), "student not enrolled"),
        (F.col("has_project"), "project does not exist"),
        (F.col("owner") == F.col("actor"), "project of another professor"),
        (F.col("vote") != NOT_SUBMITTED, "project not submitted"),
        (F.col("vote") == SUBMITTED, "project already rated"),
    ]
    if grades is not None:
        rules.append((F.col("grade").between(*grades), "grade out of range"))
    return admit(cmds, seen, rules)
