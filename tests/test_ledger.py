"""Golden ledger, event-by-event twins, and admission rules."""

import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tallystream.operators import campus
from tallystream.operators import ledger as lg

WORK = "seq bigint, type string, student string, course string, project string, grade int"


def work(spark, events):
    return spark.createDataFrame(events, WORK)


GOLDEN_WORK = [
    (6, "RATE", "s2", "c1", "p1", 30),
    (7, "SUBMIT", "s1", "c1", "p1", None),
    (8, "RATE", "s1", "c1", "p1", 17),
    (9, "SUBMIT", "s1", "c1", "p1", None),
    (10, "RATE", "s1", "c1", "p1", 25),
]


@pytest.fixture
def school(spark):
    users = spark.createDataFrame(
        [("s1", "STUDENT"), ("s2", "STUDENT"), ("t1", "PROFESSOR"), ("a1", "ADMIN")], "user_id string, role string"
    )
    log = spark.createDataFrame(
        [
            (1, "CREATE", None, "c1"),
            (2, "ENROLL", "s1", "c1"),
            (4, "ENROLL", "s2", "c1"),
            (5, "ENROLL", "s2", "c1"),
            (12, "ENROLL", "t1", "c1"),
        ],
        "seq bigint, type string, user_id string, course_id string",
    )
    projects = spark.createDataFrame(
        [(3, "c1", "p1", "t1"), (11, "c1", "p2", "t1"), (13, "c1", "p1", "t9")],
        "seq bigint, course string, project string, prof_id string",
    )
    return users, log, projects


def test_golden_ledger(spark, school):
    users, log, project_log = school
    courses = lg.course_state(log)
    enrolled = lg.enrolments(log.filter("type = 'ENROLL'"), users, courses)
    assert rows(enrolled) == [("s1", "c1", 2), ("s2", "c1", 4)] or rows(
        enrolled.select("student", "course", "since")
    ) == [("s1", "c1", 2), ("s2", "c1", 4)]
    projects = lg.projects(project_log, courses)
    assert rows(projects.select("course", "project", "prof_id")) == [("c1", "p1", "t1"), ("c1", "p2", "t1")]
    cells = lg.grade_cells(enrolled, projects)
    events = work(spark, GOLDEN_WORK)
    at_p1 = [("s1", "c1", "p1", 25), ("s2", "c1", "p1", -2)]
    assert rows(lg.grade_state(events, cells).filter("project = 'p1'")) == at_p1
    guarded = rows(lg.grade_state(events, cells, guarded=True).filter("project = 'p1'"))
    assert guarded == [("s1", "c1", "p1", 17), ("s2", "c1", "p1", -2)]
    # p2 appears after the passing grade, so the completion of c1 stands
    assert rows(lg.completions(events, projects)) == [("s1", "c1", 10)]
    assert rows(lg.completed(lg.grade_state(events, cells), projects, enrolled)) == []


def test_delete_and_new_incarnation(spark):
    log = spark.createDataFrame(
        [(1, "CREATE", "c1"), (2, "ENROLL", "c1"), (3, "DELETE", "c1"), (4, "CREATE", "c1"), (5, "ENROLL", "c1"),
         (1, "CREATE", "c2"), (2, "DELETE", "c2"), (3, "DELETE", "c9")],
        "seq bigint, type string, course_id string",
    )
    assert rows(lg.course_state(log).select("course_id", "is_deleted")) == [("c1", False), ("c2", True)]
    for hot_rows in (10**6, 2):
        got = lg.incarnations(log, hot_rows=hot_rows).filter("type = 'ENROLL'").select("seq", "incarnation")
        assert rows(got) == [(2, 1), (5, 2)]


def test_course_made_anew_is_empty(spark):
    life = spark.createDataFrame(
        [(1, "CREATE", "c1"), (20, "DELETE", "c1"), (30, "CREATE", "c1"), (1, "CREATE", "c2"), (40, "DELETE", "c2")],
        "seq bigint, type string, course_id string",
    )
    users = spark.createDataFrame([("s1", "STUDENT"), ("s2", "STUDENT")], "user_id string, role string")
    courses = lg.course_state(life)
    log = spark.createDataFrame(
        [(2, "s1", "c1"), (25, "s2", "c1"), (31, "s2", "c1"), (2, "s1", "c2")], "seq bigint, user_id string, course_id string"
    )
    enrolled = lg.enrolments(log, users, courses)
    assert rows(enrolled.select("student", "course", "since")) == [("s2", "c1", 31)]
    defined = spark.createDataFrame(
        [(3, "c1", "p1"), (24, "c1", "p9"), (32, "c1", "p2"), (33, "c1", "p3"), (3, "c2", "p1")], "seq bigint, course string, project string"
    )
    projects = lg.projects(defined, courses)
    assert rows(projects.select("course", "project")) == [("c1", "p2"), ("c1", "p3")]
    events = work(spark, [
        (4, "SUBMIT", "s1", "c1", "p1", None), (5, "RATE", "s1", "c1", "p1", 20), (21, "SUBMIT", "s1", "c1", "p1", None),
        (34, "SUBMIT", "s2", "c1", "p2", None), (35, "RATE", "s2", "c1", "p2", 30), (6, "SUBMIT", "s1", "c2", "p1", None)])
    now = lg.of_current(events, courses)
    assert rows(now.select("seq")) == [(34,), (35,)]
    votes = lg.grade_state(now, lg.grade_cells(enrolled, projects))
    assert rows(votes) == [("s2", "c1", "p2", 30), ("s2", "c1", "p3", -2)]
    turns = life.withColumnRenamed("course_id", "course")
    for hot_rows in (10**6, 2):
        tagged = lg.by_incarnation(events, turns, ["seq"], hot_rows=hot_rows)
        assert rows(tagged.select("course", "seq", "incarnation")) == [
            ("c1", 34, 3), ("c1", 35, 3), ("c1", 4, 1), ("c1", 5, 1), ("c2", 6, 1)]
        made = lg.by_incarnation(defined, turns, ["seq"], hot_rows=hot_rows)
        # done in the first c1 and kept; the second one still misses p3
        assert rows(lg.completions(tagged, made, hot_rows=hot_rows).select("student", "course", "done_at")) == [("s1", "c1", 5)]


def fold(events, project_table):
    """One event after the other, the way a consumer of the log would do it."""
    vote, history, done = {}, [], {}
    for seq, kind, s, c, p, grade in sorted(events):
        old = vote.get((s, c, p), -2)
        if kind == "SUBMIT":
            new = -1
        elif old == -1:
            new = grade
        else:
            continue
        vote[s, c, p] = new
        history.append((s, c, p, seq, old, new))
        if kind == "RATE" and (s, c) not in done:
            known = [q for n, k, q in project_table if k == c and n <= seq]
            if known and all(vote.get((s, c, q), -2) >= 18 for q in known):
                done[s, c] = seq
    return vote, history, done


@pytest.mark.parametrize("hot_rows", [10**6, 60])
def test_sequential_twin(spark, hot_rows):
    rng = random.Random(11)
    project_table = [(0, "c1", "p1"), (150, "c1", "p2"), (0, "c2", "p1"), (0, "c2", "p2"), (300, "c2", "p3")]
    born = {(c, p): n for n, c, p in project_table}
    events = []
    for seq in range(900):
        c, p = rng.choice(sorted(born))
        s = rng.choice(["s1", "s1", "s1", "s2", "s3"])
        if born[c, p] <= seq:
            events.append((seq, rng.choice(["SUBMIT", "RATE"]), s, c, p, rng.randint(10, 30)))
    vote, history, done = fold(events, project_table)
    df = work(spark, events).repartition(5)
    projects = spark.createDataFrame(project_table, "seq bigint, course string, project string")
    got = lg.grade_history(df, hot_rows=hot_rows).select(*lg.CELL, "seq", "old_vote", "new_vote")
    assert rows(got) == sorted(history, key=str)
    cells = df.select(*lg.CELL).distinct()
    assert rows(lg.grade_state(df, cells)) == sorted(
        ((*k, vote.get(k, -2)) for k in {(e[2], e[3], e[4]) for e in events}), key=str
    )
    assert rows(lg.completions(df, projects, hot_rows=hot_rows)) == sorted(((*k, n) for k, n in done.items()), key=str)


def test_maps_and_rosters(spark):
    votes = spark.createDataFrame([("s1", "c1", "p1", 20), ("s2", "c1", "p1", -1)], "student string, course string, project string, vote int")
    assert lg.evaluation_map(votes).first()["votes"] == {"s1": 20, "s2": -1}
    done = spark.createDataFrame([("s1", "c2"), ("s1", "c1"), ("s1", "c1")], "student string, course string")
    assert lg.completed_map(done).first()["courses"] == ["c1", "c2"]


def test_large_lists_come_in_pages(spark):
    enrolled = spark.range(1000).select(F.lit("c1").alias("course"), F.col("id").alias("student"))
    enrolled = enrolled.unionByName(spark.createDataFrame([("c2", 1)], "course string, student bigint"))
    projects = spark.createDataFrame([("c1", "p1"), ("c2", "p1")], "course string, project string")
    got = lg.rosters(enrolled, projects, page_rows=100).collect()
    big = [r for r in got if r["course"] == "c1"]
    assert {r["page"]: r["students"] for r in big} == {i: list(range(100 * i, 100 * i + 100)) for i in range(10)}
    assert [(r["page"], r["students"], r["projects"]) for r in got if r["course"] == "c2"] == [(0, [1], ["p1"])]


def test_await_join_keeps_unresolved_facts(spark):
    facts = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-01")], "id int, f string")
    dims = spark.createDataFrame([(1, "2024-01-02"), (2, "2024-02-01")], "id int, d string")
    facts, dims = facts.withColumn("f", F.col("f").cast("timestamp_ntz")), dims.withColumn("d", F.col("d").cast("timestamp_ntz"))
    got = lg.await_join(facts, dims, ["id"], "f", "d", "3 days")
    assert rows(got.select("id", "resolved")) == [(1, True), (2, False), (3, False)]


@pytest.fixture
def state(spark):
    make = spark.createDataFrame
    return campus.State(
        users=make([("s1", "STUDENT"), ("s2", "STUDENT"), ("t1", "PROFESSOR"), ("t2", "PROFESSOR"), ("a1", "ADMIN")], "user_id string, role string"),
        courses=make([("c1", False), ("c2", True), ("c3", False)], "course_id string, is_deleted boolean"),
        enrolments=make([("s1", "c1"), ("s1", "c3"), ("s1", "c2")], "student string, course string"),
        projects=make([("c1", "p1", "t1"), ("c1", "p2", "t1"), ("c1", "p3", "t1"), ("c3", "p1", "t1")], "course string, project string, prof_id string"),
        votes=make([("s1", "c1", "p1", -1), ("s1", "c1", "p2", 20), ("s1", "c3", "p1", 20)], "student string, course string, project string, vote int"),
        completions=make([("s1", "c3")], "student string, course string"),
    )


def reasons(df):
    return [r["reason"] for r in df.orderBy("n").collect()]


def commands(spark, names, data):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(data)], f"n int, {', '.join(n + ' string' for n in names)}")


def test_admission_rules(spark, state):
    cmds = commands(spark, ["user_id"], [("s1",), ("x",)])
    assert reasons(campus.admit_register(cmds, state)) == ["user already registered", None]
    cmds = commands(spark, ["actor", "course"], [("s1", "c9"), ("a1", "c1"), ("a1", "c2"), (None, "c1")])
    assert reasons(campus.admit_create_course(cmds, state)) == ["not an admin", "course already exists", None, "not an admin"]
    assert reasons(campus.admit_delete_course(cmds, state)) == ["not an admin", None, "course does not exist", "not an admin"]
    cmds = commands(spark, ["actor", "course"], [("t1", "c1"), ("s1", "c2"), ("s1", "c1"), ("s2", "c1")])
    assert reasons(campus.admit_enrol(cmds, state)) == [
        "not a student", "course does not exist", "student already enrolled", None]
    names = ["actor", "course", "project"]
    cmds = commands(spark, names, [("s1", "c1", "p9"), ("t1", "c2", "p1"), ("t1", "c1", "p1"), ("t1", "c1", "p9")])
    assert reasons(campus.admit_create_project(cmds, state)) == [
        "not a professor", "course does not exist", "project already exists", None]
    cmds = commands(spark, names, [
        ("t1", "c1", "p1"), ("s1", "c9", "p1"), ("s2", "c1", "p1"), ("s1", "c3", "p1"), ("s1", "c1", "p9"), ("s1", "c1", "p1"), ("s1", "c1", "p3")])
    judged = campus.admit_submit(cmds, state)
    assert reasons(judged) == [
        "not a student", "course does not exist", "student not enrolled", "course already completed",
        "project does not exist", "project already submitted", None]
    accepted, rejected = campus.split_admitted(judged)
    assert (rows(accepted.select("n")), rejected.count()) == ([(6,)], 6)
    cmds = commands(spark, ["actor", "student", "course", "project"], [
        ("s1", "s1", "c1", "p1"), ("t1", "a1", "c1", "p1"), ("t1", "s1", "c9", "p1"), ("t1", "s2", "c1", "p1"), ("t1", "s1", "c1", "p9"),
        ("t2", "s1", "c1", "p1"), ("t1", "s1", "c1", "p3"), ("t1", "s1", "c1", "p2"), ("t1", "s1", "c1", "p1")])
    assert reasons(campus.admit_rate(cmds, state)) == [
        "not a professor", "student does not exist", "course does not exist", "student not enrolled", "project does not exist",
        "project of another professor", "project not submitted", "project already rated", None]
    graded = commands(spark, ["actor", "student", "course", "project"], [("t1", "s1", "c1", "p1")]).withColumn("grade", F.lit(31))
    assert reasons(campus.admit_rate(graded, state, grades=(0, 30))) == ["grade out of range"]
    asked = commands(spark, ["student", "course", "project"], [("s1", "c1", "p1"), ("s1", "c1", "p3"), ("s1", "c1", "p2"), ("s2", "c1", "p1")])
    got = [r["answer"] for r in campus.project_check(state, asked).orderBy("n").collect()]
    assert got == ["awaiting evaluation", "not submitted", "rating: 20", "student not enrolled"]


def test_password_is_never_read_out(spark):
    users = spark.createDataFrame([("u", "n", "e", "pw", "STUDENT")], "user_id string, name string, email string, password string, role string")
    got = campus.registered_users(campus.State(users=users, courses=None))
    assert got.columns == ["user_id", "name", "email", "role"]


def test_events_look_up_the_course_they_meet_where_turns_are_few(spark, monkeypatch):
    turns = spark.createDataFrame(
        [(1, "CREATE", "a"), (1, "CREATE", "a"), (5, "DELETE", "a"), (9, "CREATE", "a"), (2, "DELETE", "b"), (None, "CREATE", "c"), (3, "CREATE", None)],
        "seq bigint, type string, course string",
    )
    events = spark.createDataFrame(
        [(i, c, i % 3) for i in (0, 3, 6, 10, None) for c in ("a", "b", "c", "d", None) if i is not None] + [(None, "a", 7)], "seq bigint, course string, n int"
    )
    columns = ["course", "seq", "n", "incarnation"]
    few = lg.by_incarnation(events, turns, ["seq"])
    plan = plan_of(few)
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1  # that of the turns
    monkeypatch.setattr(lg, "FEW_TURNS", 0)
    assert rows(few.select(*columns)) == rows(lg.by_incarnation(events, turns, ["seq"]).select(*columns))


def test_events_are_read_and_dealt_once_for_all_windows(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    events = work(spark, [(1, "SUBMIT", "s", "c", "p", None), (2, "RATE", "s", "c", "p", 20)])
    projects = spark.createDataFrame([("c", "p", 0)], "course string, project string, seq bigint")
    out = lg.completions(events.mapInArrow(count, events.schema), projects)
    assert rows(out.select("student", "course", "done_at")) == [("s", "c", 2)]
    assert seen.value == 2
