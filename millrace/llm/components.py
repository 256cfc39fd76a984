"""Connected components of a graph by alternating large-star and small-star."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import stored


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node; loops are left out."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    )


def components(
    edges: DataFrame, store: Callable[[DataFrame, str], DataFrame] = stored
) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node of its component.

    ``edges`` has the long columns a and b. Each round is written by ``store``; the
    rounds end when the edges, by then a star around every root, no longer change. Neighbours
    are never collected: a node with many edges is joined with one row, its minimum.
    """
    now = store(_downward(edges), "edges")
    state = _fingerprint(now)
    while state[0]:
        # Both stars give edges to smaller nodes; repeated ones go once, at the end.
        now = store(_small_star(_large_star(now)).distinct(), "edges")
        before, state = state, _fingerprint(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
