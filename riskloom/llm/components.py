"""Connected components of a table of links, by alternating star contraction: no node's links are ever gathered in a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K


def _large(edges: DataFrame, folder: str, tag: str) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written, so that the join of a node with very many links is between plain shuffles and can be split
    least = K.stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{tag}-large", folder)
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    # after _large() a node's links go to least nodes of its neighbours only, so none has very many here
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, folder: str, tag: str = "cc") -> DataFrame:
    """(node, component) for every node of `links` (a long, b long); a component's name is its least node.

    Each round is written to the shared folder and the round before it removed.
    """
    spark = links.sparkSession
    edges = K.stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{tag}-0", folder)
    sign, i = None, 0
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == sign:
            break
        sign, i = now, i + 1
        after = K.stored(_small(_large(edges, folder, tag)), f"{tag}-{i}", folder)
        K.remove(spark, f"{folder}/{tag}-{i - 1}")
        edges = after
    K.remove(spark, f"{folder}/{tag}-large")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
