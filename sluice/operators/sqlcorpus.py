"""Steps for corpora of questions and SQL statements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import count_of, ratio

COMPONENTS = [
    r"(?i)\bjoin\b", r"(?i)\bwhere\b", r"(?i)\bgroup +by\b", r"(?i)\bhaving\b", r"(?i)\border +by\b",
    r"(?i)\blimit\b", r"(?i)\( *select\b", r"(?i)\b(?:union|intersect|except)\b", r"(?i)\bor\b", r"(?i)\blike\b",
]


def component_count(sql: Column) -> Column:
    return reduce(lambda a, b: a + b, [count_of(sql, p) for p in COMPONENTS])


def component_difficulty(sql: Column, limits: tuple[int, int, int] = (2, 4, 6)) -> Column:
    n = component_count(sql)
    return F.when(n <= limits[0], "easy").when(n <= limits[1], "medium").when(n <= limits[2], "hard").otherwise("extra")


def execution_difficulty(results: DataFrame, key: str, passed: str = "ok",
                         limits: tuple[int, int, int] = (2, 5, 9)) -> DataFrame:
    """Band by the number of generations that ran right."""
    counts = results.groupBy(key).agg(F.count_if(F.col(passed)).alias("passes"))
    n = F.col("passes")
    band = F.when(n <= limits[0], "extra").when(n <= limits[1], "hard").when(n <= limits[2], "medium").otherwise("easy")
    return counts.withColumn("difficulty", band)


def execution_filter(df: DataFrame, results: DataFrame, keys: list[str], passed: str = "ok") -> DataFrame:
    """Statements with at least one recorded run that succeeded."""
    ran = results.filter(F.col(passed)).select(*keys).distinct()
    return df.join(ran, keys, "left_semi")


def schema_texts(ddl: DataFrame, db: str, name: str, statement: str) -> DataFrame:
    """Table definitions of each database as one text; a schema is one prompt part."""
    rows = ddl.groupBy(db).agg(F.array_sort(F.collect_list(F.struct(name, statement))).alias("_t"))
    return rows.select(db, F.array_join(F.transform("_t", lambda t: t[statement]), "\n").alias("schema_text"))


def schema_prompt(questions: DataFrame, schemas: DataFrame, db: str, question: str, template: str) -> DataFrame:
    prompt = F.replace(
        F.replace(F.lit(template), F.lit("{schema}"), F.col("schema_text")), F.lit("{question}"), F.col(question)
    )
    return questions.join(schemas, db).withColumn("prompt", prompt).drop("schema_text")


def structure_pairs(df: DataFrame, id_col: str, predicted: str, gold: str) -> DataFrame:
    """Predicted and gold structures of a record, matched by abbreviation.

    The match is inside the row: both lists belong to one record, so nothing
    is shuffled. Result: one row per gold entry, and per predicted entry
    without a gold one.
    """
    p, g = F.col(predicted), F.col(gold)
    matched = F.transform(g, lambda x: F.struct(
        x["abbreviation"].alias("abbreviation"),
        x["canonical"].alias("gold"),
        F.get(F.transform(F.filter(p, lambda y: y["abbreviation"] == x["abbreviation"]), lambda y: y["canonical"]), F.lit(0)).alias("predicted"),
    ))
    extra = F.transform(
        F.filter(p, lambda y: ~F.exists(g, lambda x: x["abbreviation"] == y["abbreviation"])),
        lambda y: F.struct(y["abbreviation"].alias("abbreviation"), F.lit(None).cast("string").alias("gold"), y["canonical"].alias("predicted")),
    )
    out = df.select(id_col, F.inline(F.concat(matched, extra)))
    return out.withColumn("equal", F.coalesce(F.col("gold") == F.col("predicted"), F.lit(False)))


def structure_accuracy(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count("gold").alias("gold_total"),
        F.count_if("equal").alias("equal_total"),
        ratio(F.count_if("equal"), F.count("gold")).alias("accuracy"),
    )
