"""Exact duplicates, combined in three stages that a hot text cannot overload.

Copies meet first inside their input partition, then inside salted digest
groups, and last across salts. Every stage groups by digest *and* whole text,
so a digest alone never decides. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content(text: Column) -> Column:
    """The compared text: null counts as empty, nothing else is changed."""
    return F.coalesce(text, F.lit(""))


# A digest with more than one in so many rows is dealt out by salts; so at most this many digests are.
HOT_SHARE = 1024


def distinct_texts(df: DataFrame, text_col: str, id_col: str, salts: int = 16) -> DataFrame:
    """One row per distinct text: ``digest``, ``keep_id`` (largest id), ``group_size``.

    The partial aggregate under each exchange is the local stage: a text leaves
    an input partition once. Digests with over a ``HOT_SHARE``-th of all rows
    are merged in salted groups first, the salt being a hash of the input
    partition, then across salts; other digests have one group. Two texts under
    one digest stop the job instead of being taken for copies.
    """
    rows = df.select(F.col(id_col).alias("_id"), content(F.col(text_col)).alias("_text"))
    rows = rows.withColumn("digest", F.sha2("_text", 256))
    share = df.count() // HOT_SHARE
    # At most HOT_SHARE rows, whatever the table holds.
    hot = F.broadcast(rows.groupBy("digest").count().filter(F.col("count") > share).select("digest"))
    salt = F.pmod(F.hash(F.spark_partition_id()), F.lit(salts))
    totals = [F.max("_keep").alias("_keep"), F.sum("_n").alias("_n")]
    merged = _merged(rows.join(hot, "digest", "left_anti"), []).unionByName(
        _merged(rows.join(hot, "digest", "left_semi").withColumn("_salt", salt), ["_salt"])
        .groupBy("digest", "_text")
        .agg(*totals)
    )
    one = merged.groupBy("digest").agg(*totals, F.count(F.lit(1)).alias("_texts"))
    clash = F.raise_error(F.lit("two texts share a digest")).cast("string")
    return one.select(
        F.when(F.col("_texts") > 1, clash).otherwise(F.col("digest")).alias("digest"),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
    )


def _merged(rows: DataFrame, salt: list[str]) -> DataFrame:
    grouped = rows.groupBy("digest", *salt, "_text").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    return grouped.drop(*salt)


def exact_groups(df: DataFrame, text_col: str, id_col: str, salts: int = 16) -> DataFrame:
    """``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` per document.

    Null and empty texts are one text. Of equal texts the row with the largest
    id stays; a row without id loses to any other, and rows without id that
    have a text to themselves stay. Rows repeated with one id and text are one
    document, returned once, all counted in ``group_size``. An empty table gives
    no rows. Further columns are not read, whatever their names.
    """
    groups = distinct_texts(df, text_col, id_col, salts)
    rows = df.select(F.col(id_col).alias("_id"), F.sha2(content(F.col(text_col)), 256).alias("digest"))
    return (
        rows.distinct()
        .join(groups, "digest")
        .select(
            F.col("_id").alias(id_col),
            "keep_id",
            "group_size",
            F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )


def exact_dedup(df: DataFrame, text_col: str, id_col: str, salts: int = 16) -> DataFrame:
    """The rows of ``df`` whose document stays, all columns as they are."""
    stays = distinct_texts(df, text_col, id_col, salts).select(F.col("digest").alias("_digest"), F.col("keep_id").alias("_keep"))
    digest = F.sha2(content(df[text_col]), 256)
    return df.join(stays, (digest == F.col("_digest")) & df[id_col].eqNullSafe(F.col("_keep")), "left_semi")
