"""Connected components by alternating large and small stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.scratch import discard, written


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least neighbour of every node, or the node itself if that is less."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node of an edge that is not the least of its component, with that least node.

    ``edges`` has ``u`` and ``v`` of one type that has an order; loops and repeated edges do no harm. Every round writes
    the edges anew and deletes the round before; their number never grows, and rounds grow with the logarithm of a
    component's size.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                  "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                        "edges")
        discard(now, least)
        least = _least(large)
        small = large.join(least, "u")
        now = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        discard(large, least)
