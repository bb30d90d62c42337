"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Writes a frame under a name in the shared folder and reads it back (cuts lineage).
Save = Callable[[DataFrame, str], DataFrame]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node points its larger neighbours at the least node it knows."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node points itself and its smaller neighbours at the least of them
    (edges run from the larger node ``u`` to the smaller ``v``)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node has one edge down at most, and none that leads on."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    degrees = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return degrees.where("down > 1 or (down = 1 and up = 1)").isEmpty()


def components(edges: DataFrame, save: Save, name: str = "stars") -> DataFrame:
    """(u, v): every node of ``edges`` but the least of its component, and that
    least node. ``edges`` holds pairs of different nodes in columns u and v.

    A round is two joins on the node, so a node of very high degree is a skewed
    join key that adaptive execution splits; the least neighbour is found with
    map-side aggregation. Rounds end when the edges are stars.
    """
    current = save(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}_0"
    )
    step = 0
    while not _is_forest(current):
        step += 1
        current = save(_small_star(_large_star(current)), f"{name}_{step}")
    return current
