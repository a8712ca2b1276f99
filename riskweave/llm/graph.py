"""Connected components by alternating stars, on any number of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialise

#: Edges of a task, at least; a few tasks for a short list.
TASK_EDGES = 100_000
FEW = 8


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable. ``edges`` has columns a, b; only their nodes.

    Each round hangs larger neighbours, then smaller ones, on the smallest, until hanging larger
    ones changes nothing. A busy node is a grouped minimum, merged before the shuffle, and a join
    that can be split.
    """
    edges = materialise(_ordered(edges))
    state = _state(edges)
    while True:
        tasks = max(FEW, state[0] // TASK_EDGES)
        both = edges.union(edges.select("b", "a"))
        least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).coalesce(tasks))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(_ordered(large).coalesce(tasks))
        if _state(edges) == state:  # every tree is a star: its nodes hang on the smallest
            break
        least = materialise(edges.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks))
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(_ordered(small.union(least)).coalesce(tasks))
        state = _state(edges)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return materialise(nodes.union(edges.select("b", "b").distinct()).coalesce(tasks))


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller, without loops."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
