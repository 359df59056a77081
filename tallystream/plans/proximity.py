"""Proximity operators over embeddings: position from components 1-3, speed from 4-6, size = label."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystream.functions import scalars as fn
from tallystream.operators import proximity as px
from tallystream.plans.registry import query
from tallystream.plans.tables import entities

D = 0.05
SHIFT = 0.5
SLICES = 8

E_SQL = """with e as (select vec_id as id, embedding[1]::double as x, embedding[2]::double as y,
  embedding[3]::double as z, embedding[4]::double as sx, embedding[5]::double as sy, embedding[6]::double as sz,
  label::bigint as size from embeddings),
 s as (select id, x + 0.5 as x, y + 0.5 as y, z + 0.5 as z, sx, sy, sz, size from e)"""

DIST = "sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z))"

PAIR_SQL = (
    E_SQL
    + f""", p as (select a.id as prey, b.id as eater, b.size as es from e a join e b
  on a.id <> b.id and a.size < b.size and {DIST} <= 0.05),
 t as (select prey, eater, es from (select *, row_number() over (partition by prey order by es desc, eater) r from p) where r = 1)"""
)

SURVIVOR_SQL = PAIR_SQL + """, v as (select id, x, y, z, size + coalesce(g, 0) as size
  from e left join (select eater, count(*) as g from t group by 1) on eater = id where id not in (select prey from t))"""


@query(
    "euclidean_3d",
    E_SQL + " select id, round(sqrt((x-sx)*(x-sx)+(y-sy)*(y-sy)+(z-sz)*(z-sz)), 9) as dist from e",
)
def euclidean_3d(spark, d):
    dist = fn.distance3(px.AXES, [f"speed.{a}" for a in px.AXES])
    return entities(spark, d).select("id", F.round(dist, 9).alias("dist"))


@query(
    "slice_of",
    E_SQL + f" select id, floor(y / {1.0 / SLICES})::int as slice from s",
)
def slice_of(spark, d):
    return entities(spark, d, SHIFT).select("id", fn.slice_of("y", 1.0, SLICES).alias("slice"))


def _moved_sql(a, top):
    p, v = f"({a} + s{a} * 4.0)", f"s{a}"
    return f"""round(case when {p} >= 1 then {top} when {p} <= 0 then 0 else {p} end, 9) as {a},
      round(case when {p} >= 1 or {p} <= 0 then -{v} else {v} end, 9) as s{a}"""


@query(
    "advance_positions",
    E_SQL + f" select id, {_moved_sql('x', 1)}, {_moved_sql('y', 0.999)}, {_moved_sql('z', 1)} from s",
)
def advance_positions(spark, d):
    moved = px.advance(entities(spark, d, SHIFT), dt=4.0, edge=1.0)
    return moved.select(
        "id",
        *[F.round(a, 9).alias(a) for a in px.AXES],
        *[F.round(f"speed.{a}", 9).alias(f"s{a}") for a in px.AXES],
    )


@query(
    "clamp_reflect",
    E_SQL + f" select id, {_moved_sql('x', 1)} from s",
)
def clamp_reflect(spark, d):
    p, v = fn.clamp_reflect(F.col("x") + F.col("speed.x") * 4.0, "speed.x", 0.0, 1.0)
    return entities(spark, d, SHIFT).select("id", F.round(p, 9).alias("x"), F.round(v, 9).alias("sx"))


@query(
    "halo_rows",
    E_SQL
    + f""", h as (select id, floor(y / {1.0 / SLICES})::int as home_slice from s)
    select id, home_slice, k::int as slice, k <> home_slice as is_halo
    from h, range(0, {SLICES}) r(k) where abs(k - home_slice) <= 2""",
)
def halo_rows(spark, d):
    out = px.halo(entities(spark, d, SHIFT), SLICES, 1.0, reach=0.2)
    return out.select("id", "home_slice", "slice", "is_halo")


@query(
    "proximity_join",
    E_SQL
    + f""" select a.id as a_id, b.id as b_id, round({DIST}, 9) as distance from e a join e b
    on a.id <> b.id and {DIST} <= 0.05""",
)
def proximity_join(spark, d):
    out = px.proximity_join(entities(spark, d), D, keep=())
    return out.select("a_id", "b_id", F.round("distance", 9).alias("distance"))


@query("larger_neighbours", PAIR_SQL + " select prey, eater, es as eater_size from p")
def larger_neighbours(spark, d):
    return px.larger_neighbours(entities(spark, d), D)


@query("dominant_match", PAIR_SQL + " select prey, eater, es as eater_size from t")
def dominant_match(spark, d):
    return px.dominant_neighbours(entities(spark, d), D)


@query("dominant_neighbours", PAIR_SQL + " select prey, eater, es as eater_size from t")
def dominant_neighbours(spark, d):
    return px.dominant_neighbours(entities(spark, d), D)


@query("absorb_round", SURVIVOR_SQL + " select id, size from v")
def absorb_round(spark, d):
    return px.absorb(entities(spark, d), D).select("id", "size")


@query("take_counts", PAIR_SQL + " select eater, count(*) as taken from t group by 1")
def take_counts(spark, d):
    return px.take_counts(px.dominant_neighbours(entities(spark, d), D))


@query(
    "population_summary",
    SURVIVOR_SQL + " select count(*) as entities, max(size) as largest, min(size) as smallest from v",
)
def population_summary(spark, d):
    return px.summary(px.absorb(entities(spark, d), D))


@query(
    "slice_counts",
    E_SQL
    + f""" select floor(y / {1.0 / SLICES})::int as slice, count(*) as entities from s
    group by rollup (floor(y / {1.0 / SLICES})::int)""",
)
def slice_counts(spark, d):
    return px.slice_counts(entities(spark, d, SHIFT), 1.0, SLICES)


@query("all_tied", SURVIVOR_SQL + " select count(*) > 1 and min(size) = max(size) as tied from v")
def all_tied(spark, d):
    return px.all_tied(px.absorb(entities(spark, d), D))


@query(
    "size_ranking",
    E_SQL + " select id, size from e order by size desc, id limit 100",
)
def size_ranking(spark, d):
    return px.ranked(entities(spark, d), 100).select("id", "size")


@query(
    "group_size_ranks",
    E_SQL + " select id, size, (row_number() over (order by size desc, id) - 1)::bigint as rank from e",
)
def group_size_ranks(spark, d):
    from tallystream.operators.ordered import number_rows

    sized = entities(spark, d).select("id", "size", (-F.col("size")).alias("down"))
    return number_rows(sized, [], ["down", "id"], "rank").select("id", "size", "rank")
