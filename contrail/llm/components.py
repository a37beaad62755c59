"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import settled, sized

EDGES_A_TASK = 100_000


def connected_components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component's name is
    its smallest node.

    Each round hangs a node's larger neighbours, then its smaller ones, on the
    smallest node that it knows; minima are partially aggregated and the joins
    are plain ones that Spark can split, so a node may have any number of
    links.  Every round is written to the shared folder.
    """
    edges = settled(sized(_ordered(links), links.count(), EDGES_A_TASK), folder, f"{name}-0")
    mark, turn = _mark(edges), 0
    while mark[0]:
        turn += 1
        edges = settled(_small_star(_large_star(edges, mark[0]), mark[0]), folder, f"{name}-{turn}")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    both = nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    return sized(both, 2 * mark[0], EDGES_A_TASK)


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links with the larger node first."""
    return (links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return r[0], r[1]


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Larger neighbours of each node to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = sized(both.groupBy("a").agg(F.min("b").alias("m")), 2 * rows, EDGES_A_TASK).select(
        F.col("a").alias("node"), F.least("a", "m").alias("m"))
    moved = both.where("b > a").join(least, F.col("a") == F.col("node")).select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return sized(_ordered(sized(moved, rows, EDGES_A_TASK)), rows, EDGES_A_TASK)


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Smaller neighbours of each node, and the node, to the smallest of them."""
    least = sized(edges.groupBy("a").agg(F.min("b").alias("m")), rows, EDGES_A_TASK).select(F.col("a").alias("node"), "m")
    moved = edges.join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    moved = sized(moved.unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b"))), 2 * rows, EDGES_A_TASK)
    return sized(_ordered(moved), 2 * rows, EDGES_A_TASK)
