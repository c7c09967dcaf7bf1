"""Connected components of an edge table, by alternating star operations.

Each round replaces links by links to smaller nodes: a large star hangs the
larger neighbours of a node on its smallest neighbour, a small star hangs the
smaller neighbours and the node itself on it.  Components and their smallest
nodes stay as they are; the rounds end when every node is linked to its
component's smallest node only, after about log(n) rounds.  A round is two
pre-aggregated minima and two joins, whose hot keys adaptive execution splits;
each round is written to the shared folder, so a lost executor costs no more
than its own part of a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.sources.sinks import stage_table


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """``edges`` (a, b), a > b, distinct -> the same components, closer to stars."""
    if small:
        # Of every node, its smaller neighbours (b) and itself.
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = moved.where("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
    else:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Only larger neighbours move: (larger, node) -> (larger, least of node).
        out = edges.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b"))
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any orderable type, in any direction, repeats and
    loops allowed -> (node, root): for every node with a link to another, the
    smallest node of its component.  No edges: no rows."""
    now = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    now = stage_table(now, "links")
    before = _state(now)
    while True:
        now = stage_table(_star(_star(now, small=False), small=True), "links")
        after = _state(now)
        if before == after:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def _state(edges: DataFrame) -> tuple:
    """Numbers that change whenever a round changes the set of links."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
