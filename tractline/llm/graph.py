"""Connected components by repeated contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractline.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every end of ``edges`` (``a``, ``b``); equal roots mean connected.

    In every round each node points to the neighbour (or itself) of least hash, drawn anew per round,
    and edges are rewritten to what their ends point to. Connected nodes stay connected, so the work
    ends when no edge is left; with random order the graph shrinks by a constant part per round.
    Edges that are null, loops or repeated are no matter. A hub is only ever pre-aggregated or joined.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(edges.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "graph-edges")
    labels, turn = None, 0
    while labels is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), "b")
        own = F.struct(F.xxhash64("a", F.lit(turn)).alias("h"), F.col("a").alias("b"))
        least = both.groupBy("a").agg(F.min(order).alias("near")).withColumn("own", own)
        steps = stored(least.select(F.col("a").alias("node"), F.least("near", "own")["b"].alias("to")), "graph-steps")
        left = steps.select(F.col("node").alias("a"), F.col("to").alias("u"))
        right = steps.select(F.col("node").alias("b"), F.col("to").alias("v"))
        moved = edges.join(left, "a").join(right, "b").filter("u <> v")
        moved = stored(moved.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "graph-edges")
        discard(edges)
        edges, before = moved, labels
        if labels is None:
            labels = steps.select("node", F.col("to").alias("root"))
        else:
            moved = steps.select(F.col("node").alias("root"), "to")
            labels = labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        labels = stored(labels, "graph-labels")
        discard(steps, *([] if before is None else [before]))
        turn += 1
    discard(edges)
    return labels
