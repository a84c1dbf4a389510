"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.common import drop, stored


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("least", F.least("u", "least"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v): the least node reachable.

    A link with a null end or to itself is ignored. Each round joins the links twice and is
    stored in the shared folder; the number of rounds grows with the logarithm of a
    component's width. Nothing is collected but one count and one sum per round.
    """
    spark = links.sparkSession
    edges, path = stored(links.select("u", "v").filter("u != v").distinct(), "links")
    state = None
    while True:
        shape = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if shape == state or not shape[0]:
            break
        state = shape
        edges, new = stored(_small_star(_large_star(edges)), "links")
        drop(spark, path)
        path = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
