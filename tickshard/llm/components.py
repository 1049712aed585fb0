"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickshard.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp): for every node of *edges* (a, b) the smallest node it reaches.

    Each round points every node at its smallest neighbour, follows these pointers twice
    and replaces nodes by what they point at. Edges inside one node vanish, so the graph
    shrinks until none is left; a chain of n nodes takes about log4(n) rounds. All state
    is in tables; nothing but the question whether edges are left comes to the driver.
    *edges* are read several times and should be stored; a pair may occur more than once.
    """
    edges = edges.where("a <> b")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to"))
        for _ in range(2):
            next_to = step.select(F.col("a").alias("to"), F.col("to").alias("further"))
            step = step.join(next_to, "to").select("a", F.col("further").alias("to"))
        step = scratch.store(step)
        if labels is None:
            labels = step.select(F.col("a").alias("node"), F.col("to").alias("comp"))
        else:
            moved = step.select(F.col("a").alias("comp"), "to")
            labels = labels.join(moved, "comp", "left").select(
                "node", F.coalesce("to", "comp").alias("comp")
            )
        labels = scratch.store(labels)
        first = step.select("a", F.col("to").alias("x"))
        second = step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = scratch.store(
            edges.join(first, "a")
            .join(second, "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return labels
