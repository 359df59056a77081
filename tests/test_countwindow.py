"""Count windows: golden values, a sequential twin, configuration, streams."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallystream.operators import countwindow as cw
from tallystream.session import fresh_dir
from tallystream.streaming import countwindow as scw
from tallystream.streaming.run import run_stream


def one_key(spark, values):
    return spark.createDataFrame(
        [("k", i, None if v is None else float(v)) for i, v in enumerate(values)], "key string, seq bigint, value double"
    )


def test_golden(spark):
    df = one_key(spark, range(1, 23))
    got = cw.count_window(df, "key", "seq", "value", 10, 5, ["Average", "sum", "max", "min"])
    assert rows(got) == [
        ("k", 0, 5.5, 55.0, 10.0, 1.0),
        ("k", 1, 10.5, 105.0, 15.0, 6.0),
        ("k", 2, 15.5, 155.0, 20.0, 11.0),
    ]
    assert cw.lane_window(df, "key", "seq", "value", 10, 5).count() == 0


def test_null_takes_no_slot(spark):
    df = one_key(spark, [1, None, 2, None, 3])
    assert rows(cw.count_window(df, "key", "seq", "value", 3, 1, ["sum"])) == [("k", 0, 6.0)]


def sequential(values, size, slide):
    held, out = [], []
    for v in values:
        held.append(v)
        if len(held) == size:
            out.append(list(held))
            held = held[slide:]
    return out


@pytest.mark.parametrize("size,slide", [(10, 5), (7, 7), (5, 1), (6, 4), (30, 2), (1, 1)])
@pytest.mark.parametrize("hot_rows", [10**6, 35])
def test_sequential_twin(spark, size, slide, hot_rows):
    rng = random.Random(size * 31 + slide)
    values = {k: [rng.randint(0, 99) for _ in range(n)] for k, n in (("a", 97), ("b", 40), ("c", 3))}
    data = [(k, i, float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "key string, seq bigint, value double").repartition(4)
    want = sorted(
        ((k, n, float(sum(w)), float(max(w))) for k, vs in values.items() for n, w in enumerate(sequential(vs, size, slide))),
        key=str,
    )
    got = cw.count_window(df, "key", "seq", "value", size, slide, ["sum", "max"], hot_rows=hot_rows)
    assert rows(got.select("key", "k", "sum", "max")) == want
    spread = cw.count_window_apply(df, "key", "seq", "value", size, slide, lambda w: w[-1] - w[0], hot_rows)
    assert rows(spread) == sorted(
        ((k, n, float(w[-1] - w[0])) for k, vs in values.items() for n, w in enumerate(sequential(vs, size, slide))),
        key=str,
    )


def test_lanes_twin(spark):
    values = list(range(100))
    want = sorted(
        (("k", lane, n, float(sum(w))) for lane in range(4) for n, w in enumerate(sequential(values[lane::4], 10, 5))),
        key=str,
    )
    for hot_rows in (10**6, 20):
        got = cw.lane_window(one_key(spark, values), "key", "seq", "value", 10, 5, aggs=["sum"], hot_rows=hot_rows)
        assert rows(got) == want


def test_config_and_route(spark):
    df = one_key(spark, range(1, 23)).unionByName(one_key(spark, [1, 2]).withColumn("key", F.lit("other")))
    config = spark.createDataFrame([("K", 10, 5, "Sum")], "key string, window_size int, slide int, fn string")
    got = cw.count_window_by_config(df, config, "key", "seq", "value")
    assert rows(got) == [("k", 0, "sum", 55.0), ("k", 1, "sum", 105.0), ("k", 2, "sum", 155.0)]
    routed, unrouted = cw.route(df, config)
    assert (routed.count(), rows(unrouted.select("key", "seq"))) == (22, [("other", 0), ("other", 1)])


@pytest.mark.parametrize("size,slide", [(10, 0), (10, 11)])
def test_bad_windows(spark, size, slide):
    with pytest.raises(ValueError):
        cw.count_window(one_key(spark, [1]), "key", "seq", "value", size, slide)
    config = spark.createDataFrame([("k", size, slide, "sum")], "key string, window_size int, slide int, fn string")
    with pytest.raises(ValueError):
        cw.count_window_by_config(one_key(spark, [1]), config, "key", "seq", "value")


def test_aggregate_names(spark):
    with pytest.raises(ValueError):
        cw.named_aggregate("median")
    empty = one_key(spark, [1]).filter("false")
    assert empty.agg(cw.named_aggregate("MAX")("value").alias("m")).first()[0] == 0.0


def test_stream_equals_batch_over_files_and_restart(spark):
    """Four files in order, the query stopped half-way and started again on its checkpoint."""
    values = [float(v) for v in range(1, 48)]
    folder = fresh_dir(spark, "readings")
    schema = "key string, seq bigint, value double, ts timestamp"

    def add(lo, hi):
        part = [("k", i, values[i]) for i in range(lo, hi)]
        frame = spark.createDataFrame(part, "key string, seq bigint, value double")
        frame.withColumn("ts", F.timestamp_seconds("seq")).coalesce(1).write.mode("append").parquet(folder)

    out, checkpoint = fresh_dir(spark, "out"), fresh_dir(spark, "checkpoint")

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        windows = scw.stream_count_window(stream, "key", "seq", "value", 10, 5, "sum")
        run_stream(windows, out, checkpoint)

    add(0, 12), add(12, 13)
    drain()
    add(13, 40), add(40, 47)
    drain()
    got = spark.read.parquet(out).select("key", "k", "value", F.unix_seconds("ts").alias("s"))
    want = [("k", n, sum(w), n * 5 + 9) for n, w in enumerate(sequential(values, 10, 5))]
    assert rows(got) == sorted(want, key=str)


@pytest.mark.parametrize("size,slide,lanes", [(10, 5, None), (7, 7, None), (100, 3, None), (6, 2, 3)])
def test_numbered_stream_in_any_order(spark, size, slide, lanes):
    """One busy key whose readings come in any order; every state holds a block of them at most."""
    rng = random.Random(size)
    values = [float(rng.randrange(100)) for _ in range(700)]
    order = list(range(700))
    rng.shuffle(order)
    schema = "key string, n bigint, value double, ts timestamp"
    folder, out, checkpoint = (fresh_dir(spark, f"numbered-{n}") for n in ("log", "out", "check"))
    held = []
    for part in (order[:300], [*order[290:500], -1], order[500:]):  # some come twice, and one without a value
        frame = spark.createDataFrame([("k", max(i, 0), values[i] if i >= 0 else None) for i in part], "key string, n bigint, value double")
        frame.withColumn("ts", F.timestamp_seconds("n")).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        windows = scw.stream_count_window(stream, "key", "n", "value", size, slide, "sum", lanes=lanes, dense=True, block_readings=64)
        run_stream(windows, out, checkpoint)
        state = spark.read.format("statestore").load(checkpoint)
        held.append([len(r[0]) for r in state.select("value.groupState.n").collect()])
    assert max(map(max, held[:2])) <= max(64, size) + 2 * size and len(held[0]) >= 3
    got = spark.read.parquet(out).select(*(["lane"] if lanes else []), "k", "value", F.unix_seconds("ts").alias("s"))
    want = []
    for lane in range(lanes or 1):
        mine = list(range(lane, 700, lanes or 1))
        windows = enumerate(sequential([values[i] for i in mine], size, slide))
        want += [(*([lane] if lanes else []), k, sum(w), mine[k * slide + size - 1]) for k, w in windows]
    assert rows(got) == sorted(want, key=str)
