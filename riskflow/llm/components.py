"""Connected components of an edge table by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
    ).first())


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("low"))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v, two different longs) to (node, root): the least node of its component.

    A round hangs the larger neighbours of each node, then the smaller ones, below the least node
    it sees (large star and small star); each is a grouping and a join, and no node's neighbours
    are gathered. The edges of a round are written, and the rounds end when nothing changes; then
    every edge leads from a node to its root.
    """
    edges = stored(edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).where("u != v").distinct(), "edges")
    before, now = None, _signature(edges)
    while before != now:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").where("v > u").select(
            F.col("v").alias("u"), F.least("low", "u").alias("v")
        ).distinct()
        down = stored(large, "edges-large")
        lows = _lowest(down)
        small = down.join(lows, "u").where("v != low").select(F.col("v").alias("u"),
                                                             F.col("low").alias("v"))
        edges = stored(
            small.unionByName(lows.select("u", F.col("low").alias("v"))).distinct(), "edges-small"
        )
        before, now = now, _signature(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
