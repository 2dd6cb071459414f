"""Counters and sessions over an event stream, with a defined fate for late rows.

The same functions take a stored table and a stream: windows and sessions are
grouped by event time, and a watermark lets the state of closed ones go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_counters(events: DataFrame, time_col: str, stage_col: str, value_col: str, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """``start``, ``end``, the stage, and count, sum, least and largest value of each window and stage.

    On a stream, rows that come more than ``delay`` behind the latest event time
    seen are late: their window is closed, and ``split_late`` says where they go.
    """
    rows = events.withWatermark(time_col, delay) if events.isStreaming else events
    return rows.groupBy(F.window(time_col, window).alias("w"), stage_col).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(value_col).alias("total"), F.min(value_col).alias("least"), F.max(value_col).alias("most")
    ).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), stage_col, "rows", "total", "least", "most")


def sessions(events: DataFrame, time_col: str, key_col: str, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """One row per session: a key's events, none further than ``gap`` from the one before.

    ``start`` and ``last`` are the first and last event; an event exactly ``gap``
    after the one before still belongs to its session.
    """
    rows = events.withWatermark(time_col, delay) if events.isStreaming else events
    return rows.groupBy(F.session_window(time_col, gap).alias("w"), key_col).agg(
        F.count(F.lit(1)).alias("rows"), F.min(time_col).alias("start"), F.max(time_col).alias("last")
    ).select(key_col, "start", "last", "rows")


def split_late(stream: DataFrame, time_col: str, output: str, late: str, checkpoint: str, delay_seconds: int = 600):
    """Run what has arrived; write rows in time to ``output`` and late ones to ``late``, both as Parquet.

    A row is late if its event time lies more than ``delay_seconds`` before the
    latest one of *earlier* micro-batches, so the rows of a batch never make each
    other late. Rows without a time are late. Both folders are written by batch
    number, so a batch that runs again after a failure replaces its own rows.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        newest = _newest(spark, output, time_col, number)
        rows = rows.persist()
        in_time = F.col(time_col).isNotNull()
        if newest is not None:
            in_time &= F.col(time_col) >= F.lit(newest) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(delay_seconds))
        rows.filter(in_time).write.mode("overwrite").parquet(f"{output}/batch={number}")
        rows.filter(~in_time).write.mode("overwrite").parquet(f"{late}/batch={number}")
        rows.unpersist()

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _newest(spark: SparkSession, output: str, time_col: str, number: int):
    """Latest event time that batches before ``number`` wrote; late rows never are the latest."""
    if number == 0:
        return None
    return spark.read.parquet(output).filter(F.col("batch") < number).agg(F.max(time_col)).first()[0]


def run_counters(counted: DataFrame, output: str, checkpoint: str):
    """Count what has arrived; every batch writes the windows that it changed below ``output``."""

    def batch(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{output}/batch={number}")

    query = (
        counted.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def latest_counters(spark: SparkSession, output: str, keys: list[str]) -> DataFrame:
    """The last state of each window: of the batches that changed it the newest counts."""
    rows = spark.read.parquet(output)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return last.select(*keys, "last.*")
