"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import Scratch, delete, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.union(edges.select("dst", "src"))
    least = both.groupBy("src").agg(F.min("dst").alias("least"))
    least = least.withColumn("least", F.least("src", "least"))
    return (
        both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
        .where("src != dst").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("least"))
    moved = down.join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    own = least.select("src", F.col("least").alias("dst"))
    return moved.where("src != dst").union(own).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of an edge: root is the smallest node it reaches.

    edges: two columns of one orderable type, in any direction, repeats and loops
    allowed; null ends are no links. Only counts reach the driver; each round is
    written to shared storage. Rounds grow as the logarithm of the nodes.
    """
    spark = edges.sparkSession
    edges = edges.toDF("src", "dst").where("src != dst").distinct()
    with Scratch(spark) as store:
        edges = store(edges, label)
        mark = _mark(edges)
        while mark[0]:
            edges = store(_small_star(_large_star(edges)), label)
            before, mark = mark, _mark(edges)
            if before == mark:
                break
            while len(store.paths) > 1:
                delete(spark, store.paths.pop(0))
        return stored(_rooted(edges), label)


def _rooted(edges: DataFrame) -> DataFrame:
    children = edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    roots = edges.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    return children.union(roots)
