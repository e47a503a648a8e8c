"""Connected components of a graph that no task or driver holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every id in the columns ``a``, ``b``.

    Rounds of contraction: every id points to the smallest of its neighbours and itself, pointers
    are followed a few steps, and edges are renamed to where their ends point; those within one
    id go.  Pointers only ever lead to smaller ids of the same component and every id that has
    an edge is merged with another, so few rounds are left with any edge, and the last pointers
    are the smallest ids.  Each round is a written table, so a lost executor costs one round at
    most.  Hubs meet pre-aggregated minima or unique pointers, never a collected list.
    """
    known = edges.select("a", "b").where(F.col("a") != F.col("b"))
    here = written(known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = None
    while True:
        to = here.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("to"))
        for _ in range(2):
            to = to.join(to.select(F.col("id").alias("to"), F.col("to").alias("next")), "to").select(
                "id", F.col("next").alias("to"))
        to = written(to, "pointers")
        if labels is None:
            labels = to.select("id", F.col("to").alias("component"))
        else:
            after = to.select(F.col("id").alias("component"), "to")
            labels = labels.join(after, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
            labels = written(labels, "labels")
        ends = here.join(to.select(F.col("id").alias("a"), F.col("to").alias("x")), "a").join(
            to.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
        here = written(ends.where(F.col("x") != F.col("y")).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
                       "edges")
        if here.isEmpty():
            return labels
