"""The corpus pipeline: documents in, packed sequences out, one stage after the other."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import exact_dedup, repeats, repetition, simhash
from sluice.llm.queries import packed
from sluice.session import intermediates

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules on repetition reject go.

    Null, empty and blank texts are too short and go. Rows are judged one by one:
    ties, repeated rows, null ids and further columns of any name come back as
    they are; an empty table stays empty.
    """
    return repetition.keep_good(docs, "text")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the largest id.

    Null and empty texts are one text. A row without id loses to any other; rows
    repeated with one id and text are one document and stay together. Further
    columns of any name come back as they are; an empty table stays empty.
    """
    return exact_dedup.exact_dedup(docs, "text", "doc_id")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    A row without id loses to any other of its group and stays in a group of its
    own; of rows with one id the one with the smallest digest of its text stays.
    Rows repeated with one id and text stay together. Null, empty and blank texts
    are one group. Further columns of any name come back as they are; an empty
    table stays empty.
    """
    return simhash.drop_near_duplicates(docs, "text", "doc_id")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has go from the text, by whole characters.

    Null texts become empty, whatever their length every text is read whole, and
    no row goes. Rows with equal ids take nothing from each other; a null id is
    larger than any other. Further columns of any name come back as they are; an
    empty table stays empty.
    """
    # Names that no column has.
    mark = "_" * (1 + max(map(len, docs.columns)))
    n_bytes, removed, kept = (mark + name for name in repeats.ADDED)
    cut = repeats.remove_repeats(docs, "text", "doc_id", whole_chars=True, added=(n_bytes, removed, kept))
    text = F.decode(kept, "UTF-8")
    return cut.withColumns({"text": text, "n_chars": F.length(text).cast("long")}).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces with their places in sequences of 2048 tokens.

    Null and empty texts are one piece of one token. Ties, repeated rows and null
    ids are packed like any other row, texts longer than a sequence are cut and
    kept whole. Further columns are not read; an empty table gives no rows.
    """
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", sequences),
]

# Rolling hashes, near-duplicate components, byte spans and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            folder = f"{intermediates(spark)}/pipeline-{uuid.uuid4().hex}"
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
