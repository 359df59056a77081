"""Scalars, record formats, sinks and event streams."""

import datetime as dt
import json
import time

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallystream.functions import scalars as fn
from tallystream.session import fresh_dir
from tallystream.sources import records as rec
from tallystream.streaming import events as sev
from tallystream.streaming import run as srun


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("out")).first()["out"]


def test_scalars(spark):
    assert one(spark, fn.title_case("s"), s="alpha bETA c") == "Alpha BETA C"
    assert one(spark, fn.title_case("s"), s="ßen ǆep ǅep ǳ ŉa ᾳx éa  İi 1a") == "ßen ǅep ǅep ǲ ŉa ᾼx Éa  İi 1a"
    assert one(spark, fn.percent_change("a", "b"), a=0.0, b=3.0) is None
    assert one(spark, fn.json_field("s", "k", "int"), s='{"k": "x"}') is None
    assert one(spark, fn.json_field("s", "k", "int"), s='{"k": "12"}') == 12
    assert [one(spark, fn.parse_bool("s"), s=s) for s in ("TRUE", "true", "yes", "")] == [True, True, False, False]
    assert one(spark, fn.classify_role("s"), s="x") == "ADMIN"
    assert one(spark, fn.classify_role("s", "register"), s="x") == "STUDENT"
    with pytest.raises(ValueError):
        fn.classify_role("s", "elsewhere")
    assert one(spark, fn.vote_status("v"), v=-1) == "awaiting evaluation"
    assert one(spark, fn.slice_of("v", 5.0, 4), v=4.999) == 3
    ts = dt.datetime(2024, 1, 2, 3, 4, 5, 678)
    assert one(spark, fn.iso_timestamp("t"), t=ts) == ts.isoformat()


def test_decode_csv(spark):
    # empty fields at the end are no fields
    lines = ["u1,n,e,p", "u1,n,e,p,STUDENT,x", "u2,,e,p,", "u2,,e,p,x"]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    good, bad = rec.decode_csv(df, "value", rec.USER_FIELDS)
    assert rows(good) == [("u1", "n", "e", "p", "STUDENT"), ("u2", "", "e", "p", "x")]
    assert rows(bad) == [("u1,n,e,p",), ("u2,,e,p,",)]
    course = spark.createDataFrame([("c1,Maths,7,TRUE",), ("c2,Art,x,no",)], "value string")
    good, bad = rec.decode_csv(course, "value", rec.COURSE_FIELDS, ["string", "string", "int", "boolean"])
    assert rows(good) == [("c1", "Maths", 7, True)] and rows(bad) == [("c2,Art,x,no",)]


def test_events_there_and_back(spark):
    columns = "subject string, type string, data string, user_id string, course_id string, project_id string, attachment string, grade int"
    data = [
        ("user", "USER", "u1,n,e,p,STUDENT", "u1", None, None, None, None),
        ("course", "CREATE", "c1,Maths,a1,false", None, "c1", None, None, None),
        ("course", "ENROLL", None, "u1", "c1", None, None, None),
        ("course", "COMPLETE", None, "u1", "c1", "p1", None, None),
        ("project", "CREATE", "p1,c1,t1", None, "c1", "p1", None, None),
        ("project", "SUBMIT", None, "u1", "c1", "p1", "file", None),
        ("project", "RATE", None, "u1", "c1", "p1", None, 25),
        ("project", "UPDATEMAP", None, "u1", "c1", "p1", None, None),
    ]
    sent = rec.encode_events(spark.createDataFrame(data, columns))
    got = {(r["topic"], r["key"], r["value"]) for r in sent.collect()}
    assert ("user-events", "u1", "u1,n,e,p,STUDENT") in got
    by_type = {(t, json.loads(v)["type"]): (k, json.loads(v)) for t, k, v in got if t != "user-events"}
    assert by_type["course-events", "CREATE"] == ("c1", {"type": "CREATE", "data": "c1,Maths,a1,false"})
    assert by_type["project-events", "CREATE"][0] == "p1"
    assert by_type["project-events", "RATE"] == (
        "u1", {"type": "RATE", "userId": "u1", "courseId": "c1", "projectId": "p1", "voto": "25"})
    assert by_type["project-events", "UPDATEMAP"] == (
        "p1", {"type": "UPDATEMAP", "studentId": "u1", "courseId": "c1", "projectId": "p1"})
    assert by_type["course-events", "COMPLETE"][0] == "u1"
    folder = fresh_dir(spark, "log")
    sent.filter("topic != 'user-events'").select("value").write.text(folder)
    back = rec.read_event_log(spark, folder)
    assert back.filter("type = 'UPDATEMAP'").first()["user_id"] == "u1"
    assert back.filter("type = 'RATE'").first()["grade"] == 25


def test_malformed_json_becomes_nulls(spark):
    df = spark.createDataFrame([('{"key":"a","value":1.5,"op":0,"sequenceNumber":7}',), ("oops",), ('{"key":"b","value":"x"}',)], "value string")
    assert rows(rec.parse_json(df, rec.SENSOR_READING)) == sorted(
        [("a", 1.5, 0, 7), (None, None, None, None), ("b", None, None, None)], key=str
    )


def test_write_batch_once_is_repeatable(spark):
    path = fresh_dir(spark, "once")
    for _ in range(2):
        srun.write_batch_once(spark.range(3), 0, path)
        srun.write_batch_once(spark.range(5), 1, path)
    assert spark.read.parquet(path).count() == 8


def test_stop_when_idle(spark):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load().filter("false")
    query = srun.flush_trigger(rate.writeStream.format("memory").queryName("idle_probe"), 1).start()
    query.stop()
    folder = fresh_dir(spark, "idle")
    spark.range(3).write.parquet(folder)
    stream = spark.readStream.schema("id bigint").parquet(folder)
    query = srun.to_table(stream, "idle_rows", fresh_dir(spark, "idle-table"), fresh_dir(spark, "idle-checkpoint"))
    started = time.monotonic()
    srun.stop_when_idle(query, seconds=2)
    assert not query.isActive and time.monotonic() - started < 60
    assert spark.table("idle_rows").count() == 3


def test_flush_options():
    assert srun.flush_options("kafka", 100) == {"maxOffsetsPerTrigger": "100"}
    assert srun.flush_options("parquet") == {"maxFilesPerTrigger": "1"}


def _files(spark, schema, *parts):
    folder = fresh_dir(spark, "parts")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _drain(spark, df):
    out = fresh_dir(spark, "drained")
    srun.run_stream(df, out, fresh_dir(spark, "drained-checkpoint"))
    return spark.read.schema(df.schema).parquet(out)


T0 = dt.datetime(2024, 1, 1)


def test_stream_dedup_across_batches(spark):
    schema = "id bigint, ts timestamp"
    first = [(i, T0 + dt.timedelta(minutes=i)) for i in range(5)]
    stream = _files(spark, schema, first, first[2:] + [(9, T0 + dt.timedelta(minutes=9))])
    got = _drain(spark, sev.stream_dedup(stream, ["id"], "ts", "1 hour"))
    assert rows(got.select("id")) == [(i,) for i in (0, 1, 2, 3, 4, 9)]


def test_await_join_gives_up_on_missing_rows(spark):
    minute = dt.timedelta(minutes=1)
    facts = _files(spark, "id bigint, ts timestamp", [(1, T0), (2, T0)], [(3, T0 + 600 * minute)], [(4, T0 + 1200 * minute)])
    dims = _files(spark, "id bigint, dts timestamp, name string", [], [(1, T0 + 5 * minute, "one")], [(8, T0 + 1200 * minute, "z")])
    out = sev.stream_await_join(facts, dims, ["id"], "ts", "dts", "10 minutes", "10 minutes", "10 minutes", "left_outer")
    got = {r["id"]: r["name"] for r in _drain(spark, out).collect()}
    assert got[1] == "one" and got[2] is None


def test_tables_of_a_batch_come_together_or_not_at_all(spark):
    path = fresh_dir(spark, "together")
    grades = spark.createDataFrame([("s1", 20), ("s2", 30)], "student string, grade int")
    done = spark.createDataFrame([("s1", "c1")], "student string, course string")
    srun.write_tables_once({"grades": grades, "done": done}, 0, path)

    def fails(batches):
        yield from batches
        raise ValueError("lost after the first half")

    broken = done.mapInPandas(fails, done.schema)
    with pytest.raises(Exception, match="lost after"):
        srun.write_tables_once({"grades": grades, "done": broken}, 1, path)
    assert srun.read_table(spark, path, "grades").count() == 2 and srun.read_table(spark, path, "done").count() == 1
    for _ in range(2):  # the batch itself, and once more
        srun.write_tables_once({"grades": grades, "done": done}, 1, path)
    assert rows(srun.read_table(spark, path, "grades").select("student", "grade")) == [("s1", 20), ("s1", 20), ("s2", 30), ("s2", 30)]
    assert rows(srun.read_table(spark, path, "done").select("student", "course")) == [("s1", "c1")] * 2


def test_resume_goes_on_from_the_checkpoint(spark):
    schema = "id bigint, ts timestamp"
    parts = [[(i, T0 + dt.timedelta(minutes=i)) for i in range(a, a + 6)] for a in (0, 4, 8)]  # they overlap
    out, checkpoint, tries = fresh_dir(spark, "resume-out"), fresh_dir(spark, "resume-checkpoint"), []

    def step(batch, batch_id):
        srun.write_batch_once(batch, batch_id, out)
        tries.append(batch_id)
        if tries.count(batch_id) == 1 and not batch.isEmpty():
            raise RuntimeError("lost")

    once = sev.stream_dedup(_files(spark, schema, *parts), ["id"], "ts", "1 hour")
    srun.resume(lambda: srun.run_batches(once, step, checkpoint), attempts=9)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(14))
    with pytest.raises(StreamingQueryException):
        tries.clear()
        srun.resume(lambda: srun.run_batches(once, step, fresh_dir(spark, "resume-again")), attempts=1)
