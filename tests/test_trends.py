"""Golden trend values, and the stream against the batch."""

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tallystream.operators import trends as tr
from tallystream.session import fresh_dir
from tallystream.streaming import trends as st
from tallystream.streaming.run import LateRows, run_stream


def day(n, month=1):
    return dt.datetime(2024, month, n)


def two_days(spark, first=10.0, second=15.0):
    data = [("A", day(1) + dt.timedelta(hours=h), first + s) for h, s in ((1, -1), (2, 1))]
    data.append(("A", day(2) + dt.timedelta(hours=5), second))
    return spark.createDataFrame(data, "grp string, ts timestamp_ntz, value double")


def test_golden_trend(spark):
    daily = tr.daily_average(two_days(spark), "ts", "grp", "value")
    assert rows(daily) == [(day(2), "A", 10.0), (day(3), "A", 15.0)]
    got = {r["date"]: (r["moving_avg"], r["pct"]) for r in tr.trend(daily).collect()}
    want = {day(3): (10.0, 0.0), day(10): (15.0, 0.0)}
    want.update({day(n): (12.5, 50.0) for n in range(4, 10)})
    assert got == want


def test_zero_start_gives_null(spark):
    daily = tr.daily_average(two_days(spark, first=0.0), "ts", "grp", "value")
    assert {r["pct"] for r in tr.trend(daily).filter(F.col("first_avg") == 0).collect()} == {None}


def test_members_are_summed_before_the_join(spark):
    data = [(1, day(1), 2.0), (1, day(1), 4.0), (2, day(1), 9.0), (3, day(1), 7.0), (1, day(1), None)]
    df = spark.createDataFrame(data, "member bigint, ts timestamp_ntz, value double")
    who = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "member bigint, grp string")
    assert rows(tr.daily_average_of_members(df, "ts", "member", "value", who)) == [
        (day(2), "A", 5.0),
        (day(2), "B", 7.0),
    ]


def test_top_group_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(day(1), "A", 50.0), (day(1), "B", 50.0), (day(1), "C", None)], "date timestamp_ntz, grp string, pct double"
    )
    assert rows(tr.top_increase(df)) == [(day(1), "B", 50.0)]


def _stream(spark, parts):
    folder = fresh_dir(spark, "trend-in")
    for part in parts:
        frame = spark.createDataFrame(part, "grp string, ts timestamp, value double")
        frame.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("grp string, ts timestamp, value double").option("maxFilesPerTrigger", 1).parquet(folder)


def _drained(spark, df):
    out = fresh_dir(spark, "trend-out")
    query = run_stream(df, out, fresh_dir(spark, "trend-checkpoint"))
    return spark.read.schema(df.schema).parquet(out), query


def test_in_time_row_counts_and_late_row_is_dropped(spark):
    h = dt.timedelta(hours=1)
    stream = _stream(
        spark,
        [
            [("A", day(1) + h, 10.0), ("A", day(2) + 2 * h, 1.0)],
            [("A", day(1) + 2 * h, 20.0)],  # within the one day allowed
            [("A", day(5), 1.0)],
            [("A", day(5) + h, 1.0)],
            [("A", day(1) + 3 * h, 90.0)],  # day 1 has been closed
            [("A", day(8), 1.0)],
        ],
    )
    late = LateRows()
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, 1)  # the count must not rest on the reports Spark keeps
    spark.streams.addListener(late)
    try:
        out, query = _drained(spark, st.stream_daily_avg(stream, "ts", "grp", "value"))
        assert late.of(query) == 1
    finally:
        spark.streams.removeListener(late)
        spark.conf.unset(kept)
    got = {r["date"]: r["daily_avg"] for r in out.collect()}
    assert got[day(2)] == 15.0


def test_stream_equals_batch_on_closed_windows(spark):
    data = [(g, day(d) + dt.timedelta(hours=3 + i), float(d * 7 % 5 + i)) for d in range(1, 21) for i, g in enumerate("ABC")]
    daily = tr.daily_average(spark.createDataFrame(data, "grp string, ts timestamp, value double"), "ts", "grp", "value")
    last = max(r[1] for r in data)
    batch = tr.trend(daily).filter(F.col("date") <= F.lit(last))
    stream = _stream(spark, [data[:20], data[20:45], data[45:]])
    moved, _ = _drained(spark, st.stream_moving_avg(stream, "ts", "grp", "value"))
    columns = ["date", "grp", "moving_avg", "first_avg", "last_avg", "pct"]
    assert rows(moved.select(columns)) == rows(batch.select(columns))
    assert moved.count() > 20
    top, _ = _drained(spark, st.stream_top_group(_stream(spark, [data[:20], data[20:]]), "ts", "grp", "value"))
    assert rows(top) == rows(tr.top_increase(batch))
