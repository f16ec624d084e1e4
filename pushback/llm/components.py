"""Connected components by alternating large-star and small-star, as joins and aggregates.

Large-star links every larger neighbour of a node to the node's smallest
neighbour; small-star links a node's smaller neighbours and itself to the
smallest of them.  Both keep the components and end with a star around each
component's smallest node.  The smallest neighbour is a partially aggregated
minimum, joined back to the edges, so no neighbourhood is ever collected.
Every round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` go from the larger (u) to the smaller node (v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """``edges``: u, v (long) -> node, component (its smallest reachable node), for nodes with an edge.

    Loops, repeated edges and edges with a null end are left out.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now).distinct()).distinct(), "cc")
        before, state = state, _state(now)
        if state == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
