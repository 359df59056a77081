"""Golden round, brute force on random clouds, and plan checks."""

import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tallystream.operators import proximity as px

SCHEMA = "id bigint, x double, y double, z double, speed struct<x double, y double, z double>, size bigint"


def cloud(spark, points):
    return spark.createDataFrame([(i, x, y, z, (0.0, 0.0, 0.0), s) for i, x, y, z, s in points], SCHEMA)


GOLDEN = [(1, 0.0, 0.0, 0.0, 1), (2, 0.5, 0.0, 0.0, 2), (3, 0.9, 0.0, 0.0, 4), (4, 5.0, 5.0, 5.0, 1)]


def test_golden_round(spark):
    df = cloud(spark, GOLDEN)
    pairs = px.larger_neighbours(df, 1.0)
    assert rows(pairs.select("prey", "eater")) == [(1, 2), (1, 3), (2, 3)]
    assert rows(px.dominant_match(pairs)) == [(1, 3, 4), (2, 3, 4)]
    assert rows(px.dominant_neighbours(df, 1.0)) == [(1, 3, 4), (2, 3, 4)]
    after = px.absorb(df, 1.0)
    assert rows(after.select("id", "size")) == [(3, 6), (4, 1)]
    assert rows(px.summary(after)) == [(2, 6, 1)]
    assert rows(px.all_tied(after)) == [(False,)]


def test_tied(spark):
    assert px.all_tied(cloud(spark, [(1, 0.0, 0.0, 0.0, 3), (2, 1.0, 0.0, 0.0, 3)])).first()[0] is True
    assert px.all_tied(cloud(spark, [(1, 0.0, 0.0, 0.0, 3)])).first()[0] is False
    assert px.all_tied(cloud(spark, GOLDEN).filter("false")).first()[0] is False


def test_advance_golden(spark):
    df = spark.createDataFrame([(1, 4.5, 4.5, 0.5, (1.0, 1.0, -1.0), 1), (2, 1.0, 1.0, 1.0, (0.5, -1.0, 0.0), 1)], SCHEMA)
    got = {r["id"]: (r["x"], r["y"], r["z"], tuple(r["speed"])) for r in px.advance(df, 1.0, 5.0).collect()}
    assert got[1] == (5.0, 4.999, 0.0, (-1.0, -1.0, 1.0))
    assert got[2] == (1.5, 0.0, 1.0, (0.5, 1.0, 0.0))


def brute(points, d):
    out = {}
    for i, x, y, z, s in points:
        best = None
        for j, a, b, c, t in points:
            if i != j and t > s and ((x - a) ** 2 + (y - b) ** 2 + (z - c) ** 2) ** 0.5 <= d:
                if best is None or (t, -j) > (best[0], -best[1]):
                    best = (t, j)
        if best:
            out[i] = (best[1], best[0])
    return sorted(((i, e, s) for i, (e, s) in out.items()), key=str)


@pytest.mark.parametrize("seed,spread,sizes", [(1, 2.0, 9), (2, 0.8, 3), (3, 6.0, 40), (4, 0.05, 500)])
def test_dominant_neighbours_brute_force(spark, seed, spread, sizes):
    rng = random.Random(seed)
    points = [(i, *(rng.uniform(-spread, spread) for _ in range(3)), rng.randint(0, sizes)) for i in range(150)]
    # a third of all entities at one point
    points += [(1000 + i, 0.1, 0.1, 0.1, rng.randint(0, sizes)) for i in range(75)]
    df = cloud(spark, points).repartition(4)
    want = brute(points, 0.5)
    assert rows(px.dominant_neighbours(df, 0.5)) == want
    assert rows(px.dominant_match(px.larger_neighbours(df, 0.5))) == want
    plain, salted = px.proximity_join(df, 0.5, keep=()), px.proximity_join(df, 0.5, keep=(), crowd_rows=10)
    assert salted.exceptAll(plain).count() == 0 and salted.count() == plain.count()


def test_crowd_forms_no_pairs(spark):
    """20,000 entities at one point and a few around it: no plan over their pairs would end."""
    crowd = spark.range(20_000).select(
        "id", *[F.lit(0.2).alias(a) for a in "xyz"], F.struct(*[F.lit(0.0).alias(a) for a in "xyz"]).alias("speed"),
        (F.col("id") % 7).alias("size"),
    )
    around = cloud(spark, [(50_000, 0.3, 0.2, 0.2, 9), (50_001, 0.4, 0.2, 0.2, 3)])
    got = px.dominant_neighbours(crowd.unionByName(around), 0.5)
    assert got.count() == 20_001
    assert rows(got.select("eater").distinct()) == [(50_000,)]


def test_no_cross_join(spark):
    df = cloud(spark, GOLDEN)
    for plan in (plan_of(px.proximity_join(df, 1.0)), plan_of(px.absorb(df, 1.0))):
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_halo_and_slices(spark):
    df = cloud(spark, [(i, 0.0, i + 0.5, 0.0, 1) for i in range(5)])
    got = px.halo(df, 5, 5.0, reach=1.0).select("id", "home_slice", "slice", "is_halo")
    want = [(i, i, k, k != i) for i in range(5) for k in range(max(0, i - 1), min(4, i + 1) + 1)]
    assert rows(got) == sorted(want, key=str)
    assert rows(px.slice_counts(df, 5.0, 5)) == sorted([(i, 1) for i in range(5)] + [(None, 5)], key=str)


def test_ranked(spark):
    assert [r["id"] for r in px.ranked(cloud(spark, GOLDEN)).collect()] == [3, 2, 1, 4]
    assert [r["id"] for r in px.ranked(cloud(spark, GOLDEN), 2).collect()] == [3, 2]
