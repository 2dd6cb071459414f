"""Table steps used between the model-backed steps of a recipe."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import BLANK, strip


def general_filter(df: DataFrame, *predicates: Column) -> DataFrame:
    """Rows for which every predicate is true; null counts as false."""
    return df.filter(reduce(lambda a, b: a & b, predicates, F.lit(True)))


def table_steps(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply caller's table functions in order, as one lazy plan."""
    for step in steps:
        df = df.transform(step)
    return df


def pack_row(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.struct(*df.columns).alias(name))


def unpack_row(df: DataFrame, name: str) -> DataFrame:
    return df.select(f"{name}.*")


def route_bands(df: DataFrame, score: str, low: float = 1, middle: float = 3) -> tuple[DataFrame, DataFrame]:
    """Rows to refine (``low < score <= middle``) and to rewrite (above)."""
    value = F.col(score)
    return df.filter((value > low) & (value <= middle)), df.filter(value > middle)


def band_label(score: Column, low: float = 1, middle: float = 3) -> Column:
    return F.when(score > middle, "rewrite").when(score > low, "refine")


def below_target(df: DataFrame, target: int = 200) -> bool:
    """Fewer than ``target`` rows; reads no more than that many."""
    return df.limit(target).count() < target


def concat_tables(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; a column missing in one of them is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def melt_questions(df: DataFrame, base: str = "question", output: str = "questions") -> DataFrame:
    """All question columns as one, nulls and repeats dropped."""
    columns = [base] if base in df.columns else []
    columns += [c for c in df.columns if re.fullmatch(r".*_question_\d+", c)]
    if not columns:
        raise ValueError("no question columns")
    long = df.select(F.explode(F.array(*columns)).alias(output))
    return long.dropna().dropDuplicates()


def extract_after(df: DataFrame, source: str = "questions", output: str = "refined_question",
                  marker: str = "#New Problem#") -> DataFrame:
    """Trimmed text after the marker; rows without it go."""
    pattern = rf"(?s){re.escape(marker)}[:{BLANK}]*(.*)"
    found = F.when(F.contains(F.col(source), F.lit(marker)), strip(F.regexp_extract(source, pattern, 1)))
    return df.withColumn(output, found).filter(F.col(output).isNotNull())


def drop_matching(df: DataFrame, part: str = "embeddings") -> DataFrame:
    return df.drop(*[c for c in df.columns if part in c])


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def choose_rows(df: DataFrame, key: str, n: int = 5, seed: str = "0") -> DataFrame:
    """A repeatable choice of ``n`` rows: smallest hashes of key and seed."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit("|" + seed)))
    return df.orderBy(order, key).limit(n)


def rows_per_key(spark: SparkSession, keys: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` numbered seed rows for every key."""
    return keys.select(key).distinct().withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def common_rows(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows in both tables, as often as in the one that has them less often."""
    return one.intersectAll(other.select(*one.columns))


def missing_rows(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of ``one`` that ``other`` lacks, as often as they are missing there."""
    return one.exceptAll(other.select(*one.columns))


def audit_split(whole: DataFrame, parts: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """What a split did to a table: a row per finding with its number of rows.

    ``lost``: rows of the table in no part; ``added``: rows of the parts that the
    table lacks; ``leaked <a> <b>``: rows that two parts share, compared by
    ``columns``. Tables are compared as multisets, so a repeated row that lost one
    of its copies counts. Nulls are equal to each other.
    """
    rows = {name: part.select(*columns) for name, part in parts.items()}
    all_parts = reduce(lambda a, b: a.unionAll(b), rows.values())
    base = whole.select(*columns)
    found = {"lost": missing_rows(base, all_parts), "added": missing_rows(all_parts, base)}
    names = sorted(rows)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            found[f"leaked {a} {b}"] = common_rows(rows[a], rows[b])
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("finding"), "rows") for name, df in found.items()]
    return reduce(lambda a, b: a.unionAll(b), counts)
