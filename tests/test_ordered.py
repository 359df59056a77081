"""Order-dependent building blocks against plain Python, with and without hot keys."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallystream.operators import ordered as od

HOT = 40  # far below the size of the busiest key, so the sliced plan is used


@pytest.fixture(scope="module")
def readings(spark):
    rng = random.Random(5)
    data = []
    for i in range(600):
        key = rng.choice(["a", "a", "a", "b", "c", None])
        data.append((key, i, rng.randint(-5, 20), f"r{i}"))
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "key string, seq bigint, amount int, tag string").repartition(5)


def _by_key(data):
    out = {}
    for row in sorted(data, key=lambda r: r[1]):
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("hot_rows", [od.HOT_ROWS, HOT])
def test_number_rows(readings, hot_rows):
    data, df = readings
    want = sorted(
        ((k, r[1], i) for k, group in _by_key(data).items() for i, r in enumerate(group)), key=str
    )
    assert rows(od.number_rows(df, "key", "seq", hot_rows=hot_rows).select("key", "seq", "rn")) == want


def test_number_rows_over_all_rows_uses_no_single_partition_sort(readings):
    data, df = readings
    numbered = od.number_rows(df, [], "seq", hot_rows=HOT)
    assert rows(numbered.select("seq", "rn")) == sorted(((r[1], r[1]) for r in data), key=str)
    from conftest import plan_of

    # the one unpartitioned window runs over the slice sizes, not over the rows
    plan = plan_of(numbered)
    singles = [b for b in plan.split("Exchange SinglePartition")[1:]]
    assert all("HashAggregate(keys=[__slice" in b.split("\n")[1] for b in singles)


@pytest.mark.parametrize("hot_rows", [od.HOT_ROWS, HOT])
def test_running_sum(readings, hot_rows):
    data, df = readings
    want = []
    for k, group in _by_key(data).items():
        total = 0
        for r in group:
            total += r[2]
            want.append((k, r[1], total))
    got = od.running_sum(df, "key", "seq", F.col("amount"), "total", hot_rows).select("key", "seq", "total")
    assert rows(got) == sorted(want, key=str)


@pytest.mark.parametrize("hot_rows", [od.HOT_ROWS, HOT])
def test_previous_values(readings, hot_rows):
    data, df = readings
    want = []
    for k, group in _by_key(data).items():
        for before, r in zip([None, *group], group):
            want.append((k, r[1], before[3] if before else None))
    got = od.previous_values(df, "key", "seq", {"before": F.col("tag")}, hot_rows).select("key", "seq", "before")
    assert rows(got) == sorted(want, key=str)


@pytest.mark.parametrize("hot_rows", [od.HOT_ROWS, HOT])
def test_rolling(readings, hot_rows):
    data, df = readings
    want = []
    for k, group in _by_key(data).items():
        for i, r in enumerate(group):
            want.append((k, r[1], max(x[2] for x in group[max(0, i - 6) : i + 1])))
    got = od.rolling(df, "key", "seq", 7, {"m": F.max("amount")}, hot_rows).select("key", "seq", "m")
    assert rows(got) == sorted(want, key=str)


def test_slices_hold_the_bound(readings):
    _, df = readings
    sliced, many = od.slice_by_order(df, "key", "seq", HOT)
    assert many
    assert sliced.groupBy("key", od.SLICE).count().agg(F.max("count")).first()[0] <= HOT + 5


def test_latest_and_first(readings):
    data, df = readings
    groups = _by_key(data)
    assert rows(od.latest_per_key(df, "key", "seq")) == sorted((g[-1] for g in groups.values()), key=str)
    assert rows(od.first_per_key(df, "key", "seq")) == sorted((g[0] for g in groups.values()), key=str)


@pytest.mark.parametrize("order", [["tag"], ["key", "amount", "tag"], ["seq"]])
def test_any_order_gives_one_result_at_every_size(readings, order):
    _, df = readings
    plain, sliced = (rows(od.number_rows(df, "key", order, hot_rows=n)) for n in (od.HOT_ROWS, HOT))
    assert plain == sliced


def test_one_tied_value(spark):
    df = spark.range(300).selectExpr("1 as key", "cast(null as string) as at", "id")
    assert rows(od.number_rows(df, "key", "at", hot_rows=HOT).select("rn")) == rows(spark.range(300))


@pytest.mark.parametrize("hot_rows", [od.HOT_ROWS, HOT])
def test_running_sum_passes_over_nulls(spark, hot_rows):
    df = spark.range(200).selectExpr("1 as key", "id", "if(id between 60 and 99, 1L, null) as amount")
    got = od.running_sum(df, "key", "id", F.col("amount"), "total", hot_rows).select("id", "total")
    assert dict(got.collect()) == {i: None if i < 60 else min(i, 99) - 59 for i in range(200)}
