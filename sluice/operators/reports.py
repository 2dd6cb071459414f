"""Dataset statistics, run reports and stage counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluice.functions import values as V


def dataset_statistics(chunks: DataFrame, text_col: str = "content", type_col: str = "data_type",
                       language_col: str = "language", types: list[str] = V.DATA_TYPES,
                       languages: list[str] = V.LANGUAGES) -> DataFrame:
    """Totals, zero-filled counts per type and language, characters and mean length."""
    length = F.length(text_col).cast("long")
    return chunks.agg(
        F.count(F.lit(1)).alias("total_chunks"),
        *[F.count_if(F.col(type_col) == t).alias(f"type_{t}") for t in types],
        *[F.count_if(F.col(language_col) == g).alias(f"language_{g}") for g in languages],
        F.coalesce(F.sum(length), F.lit(0)).alias("total_characters"),
        F.coalesce(F.avg(length), F.lit(0.0)).alias("average_chunk_length"),
    )


def with_qa_total(stats: DataFrame, qa: DataFrame) -> DataFrame:
    """Add ``total_qa_pairs``; both sides are single rows."""
    total = qa.agg(F.count(F.lit(1)).alias("total_qa_pairs"))
    return stats.withColumn("_one", F.lit(1)).join(total.withColumn("_one", F.lit(1)), "_one").drop("_one")


def watch(df: DataFrame, name: str, failed: Column | None = None) -> tuple[DataFrame, Observation]:
    """Count processed and failed rows while the stage runs, without another pass."""
    seen = Observation(name)
    failed = F.lit(False) if failed is None else failed
    return df.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if(failed).alias("failed")), seen


def stage_summary(df: DataFrame, status_col: str = "status") -> DataFrame:
    """Processed and failed counts and the success rate in percent."""
    bad = F.count_if(F.col(status_col) == "failed")
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("processed_count"),
        bad.alias("failed_count"),
        F.when(n == 0, F.lit(0.0)).otherwise((n - bad) / F.greatest(n, F.lit(1)) * 100.0).alias("success_rate"),
    )


def run_report(spark, statistics: DataFrame, observations: dict[str, Observation]) -> DataFrame:
    """One row per stage and figure: dataset totals and what each stage counted."""
    rows = [("dataset", k, float(v)) for k, v in statistics.first().asDict().items() if v is not None]
    for stage, seen in observations.items():
        rows += [(stage, k, float(v)) for k, v in seen.get.items()]
    return spark.createDataFrame(rows, "stage string, figure string, value double")


def per_source(df: DataFrame, source_col: str, score: str = "quality.overall", text_col: str = "content") -> DataFrame:
    return df.groupBy(source_col).agg(
        F.count(F.lit(1)).alias("chunks"),
        F.sum(F.length(text_col).cast("long")).alias("characters"),
        F.avg(score).alias("average_quality"),
    )


def category_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def rollups(df: DataFrame, keys: list[str], sets: list[list[str]] | None = None, text_col: str = "text") -> DataFrame:
    """Counts, characters and mean length for several groupings in one pass.

    ``sets`` are the groupings, by default every head of ``keys`` (source; source
    and language; ...) and the total. ``grouping`` has a bit for each key, the
    first highest, set where the key is summed over: it tells a null key from one
    that was left out. Rows are expanded before a map-side aggregate, so what
    crosses the network is groups, not rows.
    """
    sets = sets if sets is not None else [keys[:n] for n in range(len(keys), -1, -1)]
    size = F.length(text_col).cast("long")
    rows = df.select(*keys, size.alias("_size"))
    return rows.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(
        F.grouping_id(*keys).cast("int").alias("grouping"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("_size"), F.lit(0)).alias("characters"),
        F.avg("_size").alias("mean_length"),
    )


def length_band(text: Column, edges: list[int]) -> Column:
    """Number of the band of a text's length: how many of ``edges`` it reaches; null for a null text."""
    length = F.length(text)
    return F.when(text.isNotNull(), sum((length >= e).cast("int") for e in edges))


def vocabulary_sketches(df: DataFrame, source_col: str, text_col: str, word: str, log_size: int = 14) -> DataFrame:
    """Per source a sketch of its different lower-case words (``sketch``) and how many words it read (``words``).

    Sketches have a fixed size, can be stored and united later; the relative
    standard error of a count is about 1.04 / sqrt(2^log_size), 0.8 % at 14.
    """
    words = df.select(source_col, F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(word), F.lit(0))).alias("_w"))
    return words.groupBy(source_col).agg(
        F.hll_sketch_agg("_w", F.lit(log_size)).alias("sketch"), F.count(F.lit(1)).alias("words")
    )


def united(sketches: DataFrame) -> DataFrame:
    """One sketch of all sources, from their sketches alone."""
    return sketches.agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("words").alias("words"))


def estimated(sketches: DataFrame) -> DataFrame:
    return sketches.withColumn("distinct_words", F.hll_sketch_estimate("sketch")).drop("sketch")
