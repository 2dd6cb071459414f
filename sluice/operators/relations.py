"""Expansion of a set of entities along the relations of a knowledge base."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import durable


def related_entities(starts: DataFrame, edges: DataFrame, hops: int | None = None, start_col: str = "start") -> DataFrame:
    """``start``, ``entity`` and ``hops``: what each start reaches over ``edges`` and in how many steps at least.

    ``edges`` has ``subject`` and ``object``; a start reaches itself in no steps.
    Every round joins the newly reached with the edges and drops, by an
    anti-join, what was reached before, so cycles end; without ``hops`` rounds go
    on until nothing is new. Nothing is gathered on the driver, and a hot
    subject is left to the skew handling of the join. Null starts and edges with a
    null end reach nothing.
    """
    links = durable(
        edges.filter("subject is not null and object is not null").select(F.col("subject").alias("_from"), F.col("object").alias("_to")).distinct()
    )
    front = starts.filter(F.col(start_col).isNotNull()).select(F.col(start_col).alias("start")).distinct()
    front = durable(front.select("start", F.col("start").alias("entity"), F.lit(0).alias("hops")))
    reached, step = front, 0
    while hops is None or step < hops:
        step += 1
        new = front.join(links, front["entity"] == links["_from"]).select("start", F.col("_to").alias("entity")).distinct()
        front = durable(new.join(reached, ["start", "entity"], "left_anti").withColumn("hops", F.lit(step)))
        if front.isEmpty():
            break
        reached = reached.unionByName(front)
    return reached
