"""The domain corpus run: chunk, clean, dedupe, enhance, evaluate, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import cleaning, dedup, enhance, quality
from sluice.operators.chunking import chunk_text
from sluice.session import durable
from sluice.sources.files import read_directory
from sluice.sources.sinks import stage, write_dataset


def process_chunks(
    chunks: DataFrame,
    id_col: str = "chunk_id",
    *,
    with_clean: bool = True,
    with_dedup: bool = True,
    with_enhance: bool = True,
    with_evaluate: bool = True,
    min_score: float = 0.7,
    stage_dir: str | None = None,
    order: Column | None = None,
) -> DataFrame:
    """All row steps over a chunk table; each can be left out.

    Rows are never lost here: a duplicate or a text that fails the gate keeps
    its original content and says so in ``status`` and ``passed_gate``. Of equal
    texts the first by ``order`` (default: the id) stays. With
    ``stage_dir`` the table is written after cleaning and enhancement, so a
    later run can start from there.
    """
    df = chunks
    if with_clean:
        df = cleaning.clean(df, "content", language_col="language")
        if with_dedup:
            # Read twice below; the cleaning itself runs once.
            df = durable(df)
            # Only texts that pass the gate take part in duplicate detection.
            seen = df.filter("passed_gate")
            rank = F.struct((F.lit(0) if order is None else order).alias("place"), F.col(id_col).alias("id"))
            first = dedup.first_of_copies(seen.withColumn("_rank", rank), "cleaned", "_rank").select(
                F.col("_first.id").alias(id_col), F.lit(True).alias("_kept")
            )
            df = df.join(first, id_col, "left")
            df = df.withColumn("is_duplicate", F.col("passed_gate") & F.col("_kept").isNull()).drop("_kept")
        else:
            df = df.withColumn("is_duplicate", F.lit(False))
        df = cleaning.mark_status(df, "is_duplicate")
        df = cleaning.final_content(df).drop("cleaned")
        df = stage(df, "cleaned", stage_dir) if stage_dir else df
    if with_enhance:
        df = enhance.enhance(df, id_col, "content", language_col="language")
        df = stage(df, "enhanced", stage_dir) if stage_dir else df
    if with_evaluate:
        df = quality.evaluate(df, "content", min_score=min_score)
    return df


def run_corpus(spark: SparkSession, source: str, output: str, *, size: int = 1000, overlap: int = 100, **options) -> DataFrame:
    """Read a folder, process it and write the dataset; returns its statistics."""
    files = read_directory(spark, source)
    whole = files.filter(~F.col("data_type").isin("text", "markdown"))
    long = files.filter(F.col("data_type").isin("text", "markdown"))
    pieces = chunk_text(long, "content", size, overlap)
    pieces = pieces.withColumn("file_id", F.col("chunk_id"))
    pieces = pieces.withColumn("chunk_id", F.sha2(F.concat_ws("|", "file_id", F.col("chunk_number").cast("string")), 256))
    pieces = pieces.drop("file_id", "start")
    chunks = pieces.unionByName(whole, allowMissingColumns=True)
    # Files in order of their paths, and chunks as they stand in a file.
    place = F.struct(F.col("source.file_path"), "chunk_number", "row_number", "json_path")
    done = stage(process_chunks(chunks, order=place, **options), "processed", f"{output}/stages")
    if "generated_qa" in done.columns:
        qa = enhance.explode_qa(done, "chunk_id")
    else:
        qa = spark.createDataFrame([], "chunk_id string, position int, question string, answer string, "
                                       "context string, domain string, confidence double, method string")
    return write_dataset(done, qa, output)
