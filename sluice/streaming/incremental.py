"""Incremental runs: the same transforms over newly arrived files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.dedup import content_key


def stream_text(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """New files below ``path`` as a stream of rows."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(path)


def stream_exact_dedup(stream: DataFrame, text_col: str, event_time: str | None = None, keep_for: str = "30 days") -> DataFrame:
    """Drop texts already seen in this or an earlier batch.

    State holds one fingerprint per distinct text. With an event time it is
    dropped after ``keep_for``; without one it lasts as long as the checkpoint
    folder, and a new folder starts afresh.
    """
    keyed = stream.withColumn("_key", content_key(F.col(text_col)))
    if event_time:
        out = keyed.withWatermark(event_time, keep_for).dropDuplicatesWithinWatermark(["_key"])
    else:
        out = keyed.dropDuplicates(["_key"])
    return out.drop("_key")


def run_available(stream: DataFrame, output: str, checkpoint: str, fmt: str = "parquet"):
    """Process what has arrived since the last run, then stop."""
    query = (
        stream.writeStream.format(fmt).option("path", output).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
