"""Connected components by contraction, entirely in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolmetrics.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node that occurs in `edges` (a, b); equal labels mean connected.

    Each round every node moves to the smallest of itself and its neighbours in an order given by a hash, and the edges
    move along; edges inside one node vanish. The hash makes the expected number of rounds logarithmic, also for long
    chains. Every round ends in a written table, so a lost executor costs one round. A hub meets `min`, which is
    aggregated before the shuffle, and joins that can be split.
    """
    both = edges.select("a", "b").where("a <> b")
    left = stored(both.distinct(), "edges")
    moved = None
    while not left.isEmpty():
        arcs = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("node"))
        goes = arcs.groupBy("a").agg(F.min(F.least(rank("a"), rank("b"))).alias("to"))
        goes = stored(goes.select(F.col("a").alias("node"), F.col("to.node").alias("label")), "moves")
        if moved is None:
            moved = goes
        else:
            further = goes.select(F.col("node").alias("label"), F.col("label").alias("further"))
            moved = stored(
                moved.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label")),
                "labels",
            )
        first = goes.select(F.col("node").alias("a"), F.col("label").alias("to_a"))
        second = goes.select(F.col("node").alias("b"), F.col("label").alias("to_b"))
        relabelled = left.join(first, "a").join(second, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        left = stored(
            relabelled.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "edges",
        )
    return moved if moved is not None else both.select(F.col("a").alias("node"), F.col("b").alias("label"))
