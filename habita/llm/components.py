"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for every end of an edge (columns ``a, b``); component: the smallest node reachable.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to its smallest one (large star), then its smaller ones (small
    star). Neighbour lists are never gathered: both steps are a minimum per
    node joined back to the edges. Each round is written to the shared folder.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(both, "cc")
    if now.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(rounds):
        out = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = out.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (out.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
                                                               F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e"))
                 .select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a <> b").distinct())
        new = materialize(small, "cc")
        # done when every node points straight at a node that points nowhere
        stars = new.groupBy("a").agg(F.count("*").alias("n"))
        chained = not stars.where("n > 1").isEmpty() or not new.join(new.select(F.col("a").alias("t")).distinct(), new.b == F.col("t"), "left_semi").isEmpty()
        discard(now)
        now = new
        if not chained:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
