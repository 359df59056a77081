"""Entities in a three-dimensional box: movement, neighbourhood joins, dominant neighbours.

Entities: id, x, y, z, speed struct<x,y,z>, size. Distances are compared through cells of
edge ``d``: points within ``d`` lie in the same or an adjacent cell, so one side is sent to
its 27 cells and the join is an equi-join on the cell with an exact filter behind it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallystream.functions.scalars import clamp_reflect, distance3, slice_of
from tallystream.operators.sizing import CROWD_ROWS, spread_crowds

AXES = ("x", "y", "z")


def advance(df: DataFrame, dt: float, edge: float, eps: float = 0.001) -> DataFrame:
    """Move every entity by speed * dt; entities that leave the box stop at its border and
    turn round. The upper y border is taken back by ``eps`` to keep the last slice valid."""
    new = {
        a: clamp_reflect(F.col(a) + F.col(f"speed.{a}") * dt, f"speed.{a}", 0.0, edge, eps if a == "y" else 0.0)
        for a in AXES
    }
    return df.withColumns(
        {
            **{a: new[a][0] for a in AXES},
            "speed": F.struct(*[new[a][1].alias(a) for a in AXES]),
        }
    )


def with_slice(df: DataFrame, edge: float, n: int, axis: str = "y") -> DataFrame:
    return df.withColumn("slice", slice_of(axis, edge, n))


def halo(df: DataFrame, n: int, edge: float, reach: float, axis: str = "y") -> DataFrame:
    """Each slice with its own rows and the rows of all slices within ``reach``.

    Rows beyond the box belong to the slice at that end."""
    steps = int(-(-reach // (edge / n)))
    home = F.least(F.greatest(slice_of(axis, edge, n), F.lit(0)), F.lit(n - 1))
    wanted = F.sequence(F.greatest(home - steps, F.lit(0)), F.least(home + steps, F.lit(n - 1)))
    return (
        df.withColumn("home_slice", home)
        .withColumn("slice", F.explode(wanted))
        .withColumn("is_halo", F.col("slice") != F.col("home_slice"))
    )


def slice_counts(df: DataFrame, edge: float, n: int, axis: str = "y") -> DataFrame:
    """Entities per slice; the row with a null slice is the total."""
    return with_slice(df, edge, n, axis).rollup("slice").agg(F.count("*").alias("entities"))


def summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("entities"), F.max("size").alias("largest"), F.min("size").alias("smallest")
    )


def all_tied(df: DataFrame) -> DataFrame:
    """One row: do all entities, being more than one, have the same size?"""
    return df.agg(
        F.coalesce((F.count("*") > 1) & (F.min("size") == F.max("size")), F.lit(False)).alias("tied")
    )


def ranked(df: DataFrame, n: int | None = None) -> DataFrame:
    """Entities by size, largest first, ties by id; the first ``n`` if given."""
    ordered = df.orderBy(F.desc("size"), "id")
    return ordered if n is None else ordered.limit(n)


def _cell(d: float, names: Sequence[str] = AXES) -> list[Column]:
    return [F.floor(F.col(a) / F.lit(d)).alias(f"c{i}") for i, a in enumerate(names)]


def _around(prefix: str = "c") -> Column:
    """The 27 cells of a row's own cell and its neighbours, as structs c0, c1, c2."""

    def near(i):
        return F.sequence(F.col(f"{prefix}{i}") - 1, F.col(f"{prefix}{i}") + 1)

    planes = F.transform(
        near(0),
        lambda a: F.flatten(
            F.transform(
                near(1),
                lambda b: F.transform(
                    near(2), lambda c: F.struct(a.alias("c0"), b.alias("c1"), c.alias("c2"))
                ),
            )
        ),
    )
    return F.flatten(planes)


def proximity_join(
    df: DataFrame,
    d: float,
    condition: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    keep: Sequence[str] = ("size",),
    crowd_rows: int = CROWD_ROWS,
) -> DataFrame:
    """All ordered pairs of different entities at a distance of at most ``d``.

    ``condition(a, b)`` may narrow the pairs; ``a("size")`` is a column of the first entity.
    Columns: a_id, b_id, distance, and a_*, b_* for the columns in ``keep``. The pairs of a
    cell with more than ``crowd_rows`` entities are spread over tasks.
    """
    wanted = ["id", *AXES, *keep]
    points = df.select(*wanted, *_cell(d))
    left = points.select(*[F.col(c).alias(f"a_{c}") for c in wanted], F.explode(_around()).alias("cell"))
    left = left.select("*", "cell.*").drop("cell")
    right = points.select(*[F.col(c).alias(f"b_{c}") for c in wanted], "c0", "c1", "c2")
    cell = ["c0", "c1", "c2"]
    left, right = spread_crowds(left, right, cell, "a_id", crowd_rows)
    pairs = left.join(right, [*cell, "salt"]).filter(F.col("a_id") != F.col("b_id"))
    if condition is not None:
        pairs = pairs.filter(condition(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}")))
    dist = distance3([f"a_{a}" for a in AXES], [f"b_{a}" for a in AXES])
    return (
        pairs.withColumn("distance", dist)
        .filter(F.col("distance") <= d)
        .select("a_id", "b_id", "distance", *[f"a_{c}" for c in keep], *[f"b_{c}" for c in keep])
    )


def larger_neighbours(df: DataFrame, d: float) -> DataFrame:
    """(prey, eater, eater_size): all pairs within ``d`` whose second entity is larger."""
    pairs = proximity_join(df, d, lambda a, b: a("size") < b("size"))
    return pairs.select(
        F.col("a_id").alias("prey"), F.col("b_id").alias("eater"), F.col("b_size").alias("eater_size")
    )


def dominant_match(pairs: DataFrame) -> DataFrame:
    """Per prey the largest eater, ties to the smallest id, of pairs that are at hand; ``dominant_neighbours``
    needs no pairs."""
    return (
        pairs.groupBy("prey")
        .agg(F.max(F.struct(F.col("eater_size"), (-F.col("eater")).alias("neg"))).alias("best"))
        .select("prey", (-F.col("best.neg")).alias("eater"), F.col("best.eater_size").alias("eater_size"))
    )


def dominant_neighbours(df: DataFrame, d: float) -> DataFrame:
    """The same answer as ``dominant_match(larger_neighbours(df, d))`` without its pairs.

    The pairs of a crowded cell grow with the square of its rows. Here each cell is first
    reduced to its top entity (largest size, smallest id). An entity is compared with the
    tops of its 27 cells: a top within ``d`` settles its cell at once. Only a cell whose top
    is out of reach and would still beat the best settled one has to be looked into, and
    then only its rows that beat that best. Entities at one and the same point need no
    look: the top of the point stands for all of them.
    """
    points = df.select("id", *AXES, "size", *_cell(d))
    rank = F.struct(F.col("size"), (-F.col("id")).alias("neg"))
    spots = points.groupBy("c0", "c1", "c2", *AXES).agg(F.max(rank).alias("rank"))
    tops = spots.groupBy("c0", "c1", "c2").agg(
        F.max(F.struct("rank", *AXES)).alias("top")
    )
    # every occupied cell with the (at most 27) tops around it
    reach = tops.select(
        F.struct("c0", "c1", "c2").alias("from_cell"), "top", F.explode(_around()).alias("cell")
    )
    around = (
        reach.select("cell", F.struct("from_cell", "top").alias("near"))
        .groupBy("cell")
        .agg(F.collect_list("near").alias("near"))
    )
    seen = points.join(around.select("cell.*", "near"), ["c0", "c1", "c2"])

    def in_reach(n: Column) -> Column:
        t = n.getField("top")
        return distance3(AXES, [t.getField(a) for a in AXES]) <= d

    def rank_of(n: Column) -> Column:
        return n.getField("top").getField("rank")

    larger = F.filter("near", lambda n: rank_of(n).getField("size") > F.col("size"))
    first = seen.withColumn("near", larger).withColumn(
        "best", F.array_max(F.transform(F.filter("near", in_reach), rank_of))
    )
    first = first.withColumn(
        "open",
        F.filter(
            "near", lambda n: ~in_reach(n) & (F.col("best").isNull() | (rank_of(n) > F.col("best")))
        ),
    ).select("id", *AXES, "size", "best", "open")
    looking = first.select(
        "id", *AXES, "size", "best", F.explode_outer(F.col("open.from_cell")).alias("cell")
    ).select("id", *AXES, "size", "best", "cell.*")
    # rows of a cell that can still win for somebody who has to look into it
    bar = F.when(F.col("best").isNotNull(), F.col("best.size")).otherwise(F.col("size") + 1)
    needed = looking.filter("c0 is not null").groupBy("c0", "c1", "c2").agg(F.min(bar).alias("bar"))
    contenders = spots.join(needed, ["c0", "c1", "c2"]).filter(F.col("rank.size") >= F.col("bar"))
    contenders = contenders.select("c0", "c1", "c2", "rank", *[F.col(a).alias(f"e{a}") for a in AXES])
    beats = (
        (F.col("rank.size") > F.col("size"))
        & (F.col("best").isNull() | (F.col("rank") > F.col("best")))
        & (distance3(AXES, [f"e{a}" for a in AXES]) <= d)
    )
    return (
        looking.join(contenders, ["c0", "c1", "c2"], "left")
        .withColumn("found", F.when(beats, F.col("rank")))
        .groupBy("id")
        .agg(F.max(F.coalesce("found", "best")).alias("won"))
        .filter(F.col("won").isNotNull())
        .select(
            F.col("id").alias("prey"),
            (-F.col("won.neg")).alias("eater"),
            F.col("won.size").alias("eater_size"),
        )
    )


def take_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy("eater").agg(F.count("*").alias("taken"))


def absorb(df: DataFrame, d: float) -> DataFrame:
    """One round: every entity with a larger neighbour is taken by its dominant one, which
    grows by one per entity taken. All sizes are those at the start of the round."""
    changes = (
        dominant_neighbours(df, d)
        .select(
            F.explode(
                F.array(
                    F.struct(F.col("prey").alias("id"), F.lit(1).alias("gone"), F.lit(0).alias("grown")),
                    F.struct(F.col("eater").alias("id"), F.lit(0).alias("gone"), F.lit(1).alias("grown")),
                )
            ).alias("c")
        )
        .groupBy("c.id")
        .agg(F.max("c.gone").alias("gone"), F.sum("c.grown").alias("grown"))
    )
    return (
        df.join(changes, "id", "left")
        .filter(F.coalesce("gone", F.lit(0)) == 0)
        .withColumn("size", F.col("size").cast("long") + F.coalesce("grown", F.lit(0)))
        .drop("gone", "grown")
    )
