"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallystream.session import cut_lineage


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written to the shared folder, and a sum that changes when they do."""
    stored = cut_lineage(edges.distinct())
    seen = stored.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).head()
    return stored, tuple(seen)


def component_labels(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the undirected edges (u, v).

    Edges are turned towards ever smaller neighbours, in two steps a round: larger neighbours
    of a node, then smaller ones, go to the smallest node around it. After a number of rounds
    logarithmic in the longest path every node points at its component's smallest. Each round
    is written out, so the plan stays short and a lost executor costs one round at most. Minima
    are partial sums; the joins on hubs can be split by adaptive execution.
    """
    both = edges.filter(F.col("u") != F.col("v"))
    current, mark = _stored(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while mark[0]:
        around = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = around.join(least, F.col("u") == F.col("w")).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.filter(F.col("u") != F.col("v")).distinct())
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("w")).filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, changed = _stored(small.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))))
        if changed == mark:
            break
        current, mark = after, changed
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
