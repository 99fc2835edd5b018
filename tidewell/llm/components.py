"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.tables import forget, settle


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, component)`` with the smallest node reachable.

    Only nodes that have an edge to another node appear; null ends and self-loops are ignored, repeated
    edges count once, an empty table gives an empty table. Each round joins edges with one minimum per
    node; minima are pre-aggregated before the shuffle, so a hub with a third of all edges costs one row
    per task, and the joins on a hub are plain equi-joins whose skewed side AQE splits.
    """
    e = edges.where("a is not null and b is not null and a <> b")
    e = settle(e.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    mark = _mark(e)
    while mark[0]:
        ends = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(e.select("hi", "lo"))
        least = ends.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("lo"), F.least("u", "m").alias("m"))
        large = e.join(least, "lo").select("hi", F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = lowest.select("hi", F.col("m").alias("lo")).union(large.join(lowest, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        before, e = e, settle(small.where("hi <> lo").distinct())
        forget(before)
        was, mark = mark, _mark(e)
        if was == mark:
            break
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        e.select("lo", "lo").distinct()
    )
