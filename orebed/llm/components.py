"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed import paths
from orebed.session import fresh_dir


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), both bigint; the root is its component's smallest node.

    Each round points every node and its larger neighbours at its smallest
    neighbour, then its smaller neighbours at the smallest of them, until only
    stars are left: about the logarithm of the longest chain. A node with very
    many links meets them in aggregates that combine before the shuffle and in
    joins that adaptive execution may split. Each round is written to the
    shared folder and replaces the one before.
    """
    spark = links.sparkSession
    at, mark = None, None
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    while True:
        path = fresh_dir(spark, "links")
        edges.write.parquet(path)
        edges = spark.read.schema("a bigint, b bigint").parquet(path)
        if at is not None:
            paths.remove(spark, at)
        at = path
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == mark:
            break
        mark = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _small_star(_large_star(both, edges)).distinct()
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _large_star(both: DataFrame, edges: DataFrame) -> DataFrame:
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")).withColumnRenamed("a", "centre")
    # Larger neighbours of b are the a of its links.
    return edges.join(lowest, edges["b"] == lowest["centre"]).select("a", F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "centre")
    inner = edges.join(lowest, edges["a"] == lowest["centre"]).filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return inner.unionByName(lowest.select(F.col("centre").alias("a"), F.col("low").alias("b")))
