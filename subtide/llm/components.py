"""Connected components by alternating stars: every round is two joins, and no group is
gathered; a node with very many neighbours is split over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm.scratch import store
from subtide.operators.joins import hash_join


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to its least one."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return hash_join(both, least, ["a"], "inner").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node, are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = hash_join(edges, least, ["a"], "inner")
    return (
        tied.filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        .unionByName(least.select("a", F.col("least").alias("b"))).distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the component's
    least node. Loops and repeated edges do no harm; no edge gives no row."""
    def mark(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31)), F.sum(F.xxhash64("b", "a") % (1 << 31))).first())

    now = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = mark(now)
    while seen[0]:
        now = store(_small_star(_large_star(now)), "edges")
        last, seen = seen, mark(now)
        if seen == last:
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
