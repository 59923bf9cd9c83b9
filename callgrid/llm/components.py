"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callgrid.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v): the smallest node that it reaches.

    Each round hangs the larger neighbours of a node, then its smaller ones, under the
    smallest it knows, until nothing changes; rounds grow with the logarithm of the nodes.
    All steps are joins and partial aggregates over the links, written to the shared folder.
    """
    edges = written(links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        small = small.select("u", "low").union(small.where(F.col("v") != F.col("low")).select("v", "low"))
        edges = written(small.toDF("u", "v").distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
