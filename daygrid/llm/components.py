"""Connected components of a graph of any size, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import scratch_tables, staged, staged_in_place_of


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    # A node that is nobody's smaller neighbour passes its link on unchanged by the small star.
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the long pairs (a, b); root is the component's least node.

    Null ends and loops are no links. Both steps only aggregate and join on nodes, and no
    neighbour list is ever gathered, so a node with very many links is no single task's
    work: minima combine before the shuffle and Spark splits the joins' large partitions.
    Every round is written to the shared folder in place of the one before. Rounds end when
    nothing changes.
    """
    links = pairs.where("a is not null and b is not null and a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    begun = len(scratch_tables())
    edges = staged(links.distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        edges = staged_in_place_of(_small_star(_large_star(edges)), "edges", begun)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
