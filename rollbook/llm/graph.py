"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import settle


def _shape(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node that is not its component's smallest, with that smallest node.

    Large-star and small-star steps in turn: each node hands its larger, then its smaller neighbours to the smallest it
    knows. Minima are aggregated before the shuffle, the joins have one row per node on one side, and nothing
    is collected but a count and a checksum that tell when nothing changes.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = settle(edges, "edges")
    shape = _shape(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # a node that is its neighbours' smallest keeps them by its own link to them
        large = settle(large.distinct(), "edges")
        least = settle(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select("u", "v", "m")
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = settle(small.filter("u <> v").distinct(), "edges")
        before, shape = shape, _shape(edges)
        if shape == before:
            return edges
