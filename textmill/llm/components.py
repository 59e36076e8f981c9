"""Connected components by contraction, as joins and aggregates over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textmill.sources.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``edges(a, b)``: the smallest id that its edges reach.

    In each round every vertex points to its smallest neighbour, if that is smaller, and then to where
    that one points; edges between vertices that now point to the same one go. The graph at least
    halves, so rounds grow as the logarithm of its size. Aggregates combine before the shuffle, and
    in the joins the side with one row for each vertex is unique, so a vertex with many edges is
    split like any skewed key. Nothing but a count comes to the driver.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(ordered.filter("a <> b").distinct(), "edges")
    ids = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    found = None
    while True:
        if found is not None and edges.isEmpty():
            return found
        low = edges.groupBy("a").agg(F.min("b").alias("to"))
        far = low.select(F.col("a").alias("to"), F.col("to").alias("further"))
        jump = stage(low.join(far, "to", "left").select("a", F.coalesce("further", "to").alias("to")), "jump")
        if found is None:
            found = ids.withColumn("component", F.col("id"))
        moved = found.join(jump, found["component"] == jump["a"], "left")
        found = stage(moved.select("id", F.coalesce("to", "component").alias("component")), "components")
        for side in ("a", "b"):
            there = jump.select(F.col("a").alias("_from"), F.col("to").alias("_to"))
            edges = edges.join(there, edges[side] == there["_from"], "left")
            edges = edges.withColumn(side, F.coalesce("_to", side)).drop("_from", "_to")
        ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = stage(ordered.filter("a <> b").distinct(), "edges")
