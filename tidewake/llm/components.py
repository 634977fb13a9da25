"""Connected components of an edge table by alternating large and small stars, all in joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node that a row ``x, y`` of ``links`` names."""
    edges = links.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).filter("hi <> lo").distinct()
    edges = checkpointed(edges)
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(edges.select(F.col("lo").alias("a"), F.col("hi").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo").distinct()
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*")
        edges = checkpointed(small.filter("hi <> lo").distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
