"""Connected components of a distributed edge list.

Alternating large-star and small-star steps (Kiveris et al., 2014): every
step is one grouped minimum and one join over the edges, so no component
is ever gathered anywhere.  Each step is written to the shared folder,
which cuts the lineage of the loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialpages.plans.lineage import discard, staged


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """One step.  ``edges`` holds (u, v) with u > v.  Large star looks at all
    neighbours of a node and moves the larger ones to the least; small star
    looks at the smaller neighbours and moves them and the node itself."""
    seen = edges.union(edges.select("v", "u")).toDF("u", "v") if both else edges
    least = seen.groupBy("u").agg(F.min("v").alias("m"))
    if both:
        least = least.select("u", F.least("u", "m").alias("m"))
        moved = seen.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = seen.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
    return moved.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is the
    least node of its component.  Loops and repeated edges are allowed; nulls
    are dropped; no edges give no rows."""
    edges = (
        edges.where("a is not null and b is not null")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct()
    )
    spark = edges.sparkSession
    edges, path = staged(edges)
    state = _state(edges)
    while state[0]:
        large, between = staged(_star(edges, both=True))
        discard(spark, path)
        edges, path = staged(_star(large, both=False))
        discard(spark, between)
        new = _state(edges)
        if new == state:
            break
        state = new
    # at the fixed point every edge leads from a node to its root
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()
