"""Connected components of a graph by alternating large and small stars, as joins and minima."""

from pyspark.sql import DataFrame, functions as F

from lograil.session import scratch_dir


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again: later steps start from there."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node on an edge (a, b): the smallest node that it reaches.

    Each round hooks all larger neighbours of a node, then all smaller ones, to the smallest. The
    number of rounds grows with the logarithm of the longest path. Every round's edges are a
    written table; the driver sees their count and a checksum, no rows.
    """
    stars = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    while True:
        stars = saved(_small_star(_large_star(stars)), name)
        mark = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        stars.select("v", F.col("v").alias("component")).distinct())
