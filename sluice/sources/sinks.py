"""Sinks, stage tables and error routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.reports import dataset_statistics, with_qa_total


def write_dataset(chunks: DataFrame, qa: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> DataFrame:
    """``chunks/``, ``qa_pairs/`` and a one-row ``statistics/``; returns the statistics.

    Both tables are written by all tasks. Statistics are computed from what was
    written, so the upstream plan runs once.
    """
    chunks.write.mode(mode).format(fmt).save(f"{path}/chunks")
    qa.write.mode(mode).format(fmt).save(f"{path}/qa_pairs")
    spark = chunks.sparkSession
    stats = with_qa_total(
        dataset_statistics(spark.read.schema(chunks.schema).format(fmt).load(f"{path}/chunks")),
        spark.read.schema(qa.schema).format(fmt).load(f"{path}/qa_pairs"),
    )
    stats.coalesce(1).write.mode(mode).json(f"{path}/statistics")
    return spark.read.schema(stats.schema).json(f"{path}/statistics")


def write_records(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Recipe output; ``json`` means one object per line."""
    df.write.mode(mode).format("json" if fmt == "jsonl" else fmt).save(path)


def stage(df: DataFrame, name: str, folder: str) -> DataFrame:
    """Write a stage table with all columns and go on from it."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return load_stage(df.sparkSession, name, folder)


def load_stage(spark: SparkSession, name: str, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def quarantine(df: DataFrame, failure: Column, on_error: str = "skip") -> tuple[DataFrame, DataFrame]:
    """Good rows and failed rows; ``failure`` is a message or null.

    With ``on_error="stop"`` the first failed row ends the job when it runs.
    """
    if on_error not in ("skip", "stop"):
        raise ValueError("on_error is skip or stop")
    marked = df.withColumn("error", failure)
    if on_error == "stop":
        # coalesce keeps the check from being dropped as an unused column.
        checked = marked.filter(F.when(F.col("error").isNotNull(), F.raise_error(F.col("error")).cast("boolean")).otherwise(True))
        return checked.drop("error"), marked.limit(0)
    return marked.filter(F.col("error").isNull()).drop("error"), marked.filter(F.col("error").isNotNull())
