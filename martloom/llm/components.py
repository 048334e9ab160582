"""Connected components of an edge table, by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.sources.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, root)`` for every vertex of ``edges(u, v)``; the root is the smallest vertex reachable.

    Each round hooks every vertex to its smallest neighbour, shortens the hooks by one step and
    contracts the edges to their hooks. Every vertex but the local minima vanishes, so the edges at
    least halve their vertices per round; the smallest vertex of a component never hooks elsewhere.
    Rounds are stored in the shared folder. Minima combine on the map side, and the joins with stored
    hooks can be split where a vertex has very many edges. Null ends and self-loops are ignored.
    """
    edges = stage(
        edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct(), "edges"
    )
    ends = lambda e: e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = None
    while not edges.isEmpty():
        nearest = ends(edges).groupBy("u").agg(F.min("v").alias("v"))
        hooks = stage(nearest.select("u", F.least("u", "v").alias("to")), "hooks")
        next_hop = hooks.select(F.col("u").alias("to"), F.col("to").alias("beyond"))
        hooks = stage(hooks.join(next_hop, "to").select("u", F.col("beyond").alias("to")), "hooks")
        if labels is None:
            labels = hooks.select(F.col("u").alias("vertex"), F.col("to").alias("root"))
        else:
            moved = hooks.select(F.col("u").alias("root"), F.col("to").alias("to"))
            labels = stage(
                labels.join(moved, "root", "left").select("vertex", F.coalesce("to", "root").alias("root")), "labels"
            )
        of_u = hooks.select("u", F.col("to").alias("a"))
        of_v = hooks.select(F.col("u").alias("v"), F.col("to").alias("b"))
        edges = stage(
            edges.join(of_u, "u")
            .join(of_v, "v")
            .where("a <> b")
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
            .distinct(),
            "edges",
        )
    if labels is None:
        return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    return labels
