"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import durable


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node with an edge.

    ``edges`` has columns ``a`` and ``b``. Large and small stars alternate: each
    node hands its larger neighbours, then its smaller ones, to the smallest
    node it knows. Every round is a few joins and a stored table of at most
    one edge per old edge; rounds grow with the logarithm of the longest path.
    Nothing is gathered per component or on the driver.
    """
    now = durable(edges.filter("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    mark = _mark(now)
    while mark[0]:
        both = now.select("v", "u").union(now.select("u", "v"))
        lowest = both.groupBy("v").agg(F.min("u").alias("_m")).select("v", F.least("_m", "v").alias("m"))
        large = both.join(lowest, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = durable(large.filter("v != u").distinct())
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        # The smallest neighbour takes the node itself and its other smaller neighbours.
        small = large.join(lowest, "v").select(F.explode(F.array("v", "u")).alias("v"), F.col("m").alias("u"))
        now = durable(small.filter("v != u").distinct())
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        now.select("u").distinct().select("u", F.col("u").alias("root"))
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
