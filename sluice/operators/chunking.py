"""Chunking and the gates in front of it."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import TOKEN, find_all, let, strip
from sluice.operators.skew import skew_join

SEPARATORS = ["\n\n", "\n", "。", ". ", "！", "! ", "？", "? "]
PIECES = "array<struct<chunk_number:int,start:int,text:string>>"


def min_length(df: DataFrame, text_col: str, n: int = 10) -> DataFrame:
    return df.filter(F.length(strip(F.col(text_col))) >= n)


def is_valid(text: Column) -> Column:
    """Blank rows are passed through untouched by the steps that ask this."""
    return F.coalesce(strip(text) != "", F.lit(False))


def cut_ends(text: str) -> list[tuple[int, list[int]]]:
    """For each separator, most wanted first, its length and where its occurrences end, in order."""
    found = ((len(s), [m.start() + len(s) for m in re.finditer(f"(?={re.escape(s)})", text)]) for s in SEPARATORS)
    return [(width, ends) for width, ends in found if ends]


def piece_limits(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Start and end of the pieces of one text.

    All separators are looked up once; each cut then is a binary search in
    their sorted ends, the last that fits the window and leaves a piece.
    """
    table = cut_ends(text) if len(text) > size else []
    begin = 0
    while begin < len(text):
        limit = begin + size
        if limit >= len(text):
            yield begin, len(text)
            return
        fitting = ((width, ends[bisect_right(ends, limit) - 1]) for width, ends in table if ends[0] <= limit)
        cut = next((end for width, end in fitting if end - width > begin), limit)
        yield begin, cut
        # An overlap that would not move forward is left out.
        begin = cut - overlap if cut - overlap > begin else cut


def chunk_pieces(text: Column, size: int = 1000, overlap: int = 100) -> Column:
    """Cut one text at the last separator in each window of ``size`` characters.

    Where a cut falls depends on the cut before it, so this one step is an
    Arrow function; a row carries one document, so the work spreads with rows.
    """
    # Bound here, so that the function travels with its helpers.
    limits = piece_limits

    @F.pandas_udf(PIECES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def pieces(content: str) -> list[dict]:
            places = enumerate(limits(content, size, overlap))
            return [{"chunk_number": n, "start": a, "text": content[a:b]} for n, (a, b) in places]

        for batch in batches:
            yield batch.map(pieces, na_action="ignore")

    return run(text)


def chunk_text(
    df: DataFrame, text_col: str = "content", size: int = 1000, overlap: int = 100, min_len: int = 10
) -> DataFrame:
    """One row per piece; short texts stay whole and are not sent to Python."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be below the chunk size")
    text = F.col(text_col)
    df = df.withColumn(text_col, strip(text)).filter(text.isNotNull())
    whole = F.array(
        F.struct(F.lit(0).alias("chunk_number"), F.lit(0).alias("start"), text.alias("text"))
    ).cast(PIECES)
    pieces = F.coalesce(chunk_pieces(F.when(F.length(text) > size, text), size, overlap), whole)
    trimmed = F.transform(pieces, lambda p: p.withField("text", strip(p["text"])))
    kept = F.filter(trimmed, lambda p: F.length(p["text"]) >= min_len)
    # The pieces of a text are in one cell here, so their number needs no shuffle.
    counted = let(kept, lambda k: F.transform(k, lambda p: p.withField("total_chunks", F.size(k))))
    others = [c for c in df.columns if c != text_col]
    return df.select(*others, F.inline(counted)).withColumnRenamed("text", text_col)


def chunk_fixed(
    df: DataFrame, text_col: str = "content", size: int = 1000, overlap: int = 100
) -> DataFrame:
    """Fixed stride, no separators; the piece that reaches the end is the last."""
    stride = size - overlap
    text = F.col(text_col)
    starts = F.sequence(
        F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(stride)
    )
    starts = F.filter(starts, lambda s: (s == 0) | (s < F.length(text) - overlap))
    pieces = F.transform(
        starts,
        lambda s, i: F.struct(
            i.cast("int").alias("chunk_number"),
            s.cast("int").alias("start"),
            F.substring(text, s + 1, F.lit(size)).alias("piece"),
        ),
    )
    others = [c for c in df.columns if c != text_col]
    out = df.filter(F.length(text) > 0).select(*others, F.inline(pieces))
    return out.withColumnRenamed("piece", text_col)


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN))


def chunk_tokens(df: DataFrame, text_col: str = "content", n: int = 512) -> DataFrame:
    """Pieces of ``n`` word or mark tokens, joined by one blank."""

    def cut(tokens: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1)), F.lit(n))
        return F.transform(
            firsts,
            lambda first, i: F.struct(
                i.cast("int").alias("chunk_number"),
                F.array_join(F.slice(tokens, first, F.lit(n)), " ").alias("piece"),
            ),
        )

    others = [c for c in df.columns if c != text_col]
    out = df.select(*others, F.inline(let(find_all(F.col(text_col), TOKEN), cut)))
    return out.withColumnRenamed("piece", text_col).filter(F.length(text_col) > 0)


def number_chunks(df: DataFrame, source: str | list[str]) -> DataFrame:
    """Pieces per source, next to each piece.

    Counted by an aggregate and joined back: the counts combine before the
    shuffle, so a source that owns most pieces is no single task's burden.
    """
    keys = [source] if isinstance(source, str) else source
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_chunks"))
    return skew_join(df, totals, keys)


