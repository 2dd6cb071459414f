"""Enhancement: terms, question-answer pairs, enrichment and domain tags.

Terms live in one array column per chunk, so the whole stage is a projection:
no join and no shuffle. Dictionaries are parameters of checked size.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.text import (
    BLANK,
    CJK_RUN,
    NUMBER,
    barrier,
    contains_any,
    contains_cjk,
    find_all,
    hash_pick,
    let,
)
from sluice.operators.cleaning import segment_marked

TERM_FIELDS = "struct<term:string,type:string,confidence:double,aliases:array<string>,entity_info:map<string,string>>"
TERMS = f"array<{TERM_FIELDS}>"
QA_FIELDS = "struct<ordinal:int,question:string,answer:string,context:string,domain:string,confidence:double,method:string>"
QA = f"array<{QA_FIELDS}>"
MAX_DICTIONARY = 20_000
# Rows whose windows a Python worker holds at once.
WINDOW_ROWS = 64


@dataclass
class Knowledge:
    """Terms with aliases, entities with facts, and relations between them.

    Small by contract: it becomes part of the expressions, so more than
    ``MAX_DICTIONARY`` entries are refused rather than shipped with each task.
    """

    terms: dict[str, list[str]] = field(default_factory=lambda: dict(V.KB_TERMS))
    entities: dict[str, dict[str, str]] = field(default_factory=lambda: dict(V.KB_ENTITIES))
    relations: list[tuple[str, str, str]] = field(default_factory=lambda: list(V.KB_RELATIONS))

    def __post_init__(self) -> None:
        if len(self.terms) + len(self.entities) > MAX_DICTIONARY:
            raise ValueError(f"knowledge base above {MAX_DICTIONARY} entries")

    def updated(self, terms: dict[str, list[str]] | None = None, entities: dict | None = None) -> "Knowledge":
        return Knowledge({**self.terms, **(terms or {})}, {**self.entities, **(entities or {})}, self.relations)

    def words(self) -> list[str]:
        return [*self.terms, *self.entities]

    def frames(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        return (
            spark.createDataFrame(list(self.terms.items()), "term string, aliases array<string>"),
            spark.createDataFrame(list(self.entities.items()), "entity_id string, info map<string,string>"),
            spark.createDataFrame(self.relations, "subject string, relation string, object string"),
        )


def _term_struct(term: Column, kind: str, aliases: Column | None = None, info: Column | None = None) -> Column:
    return F.struct(
        term.alias("term"),
        F.lit(V.TERM_TYPES[kind]).alias("type"),
        F.lit(V.TERM_CONFIDENCE[kind]).alias("confidence"),
        (F.lit(None) if aliases is None else aliases).cast("array<string>").alias("aliases"),
        (F.lit(None) if info is None else info).cast("map<string,string>").alias("entity_info"),
    ).cast(TERM_FIELDS)


def _alias_array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _info_map(info: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in info.items() for x in pair])


def chinese_terms(text: Column, kb: Knowledge, indicators: str = V.TERM_INDICATORS) -> Column:
    """Dictionary terms, entities and likely terms, in text order, each once.

    Pieces come from dictionary matching (longest word first). A piece of two
    to four characters with an indicator character is a likely term.
    """
    if not kb.words():
        pieces = find_all(text, CJK_RUN)
    else:
        pieces = find_all(segment_marked(text, kb.words()), CJK_RUN)
    size = F.length
    known = kb.words() or [""]
    useful = F.filter(
        F.array_distinct(pieces),
        lambda w: (size(w) > 1) & (w.isin(known) | (size(w).between(2, 4) & w.rlike(f"[{indicators}]"))),
    )
    lookup = None
    if kb.terms:
        lookup = F.create_map(*[x for t, a in kb.terms.items() for x in (F.lit(t), _alias_array(a))])
    facts = None
    if kb.entities:
        facts = F.create_map(*[x for e, i in kb.entities.items() for x in (F.lit(e), _info_map(i))])

    def describe(word: Column) -> Column:
        out = _term_struct(word, "suspected")
        if facts is not None:
            out = F.when(word.isin(list(kb.entities)), _term_struct(word, "entity", info=F.try_element_at(facts, word))).otherwise(out)
        if lookup is not None:
            out = F.when(word.isin(list(kb.terms)), _term_struct(word, "term", aliases=F.try_element_at(lookup, word))).otherwise(out)
        return out

    return F.transform(useful, describe)


def english_terms(text: Column, dictionary: list[str] = V.ENGLISH_TERMS) -> Column:
    """Single words of the list, lower-cased, each once; two-word entries never match."""
    words = F.array_distinct(find_all(F.lower(text), r"\b[a-z]+\b"))
    return F.transform(
        F.filter(words, lambda w: (F.length(w) > 1) & w.isin(dictionary)), lambda w: _term_struct(w, "english")
    )


def extract_terms(
    df: DataFrame,
    text_col: str = "content",
    language_col: str | None = None,
    kb: Knowledge | None = None,
    english: list[str] = V.ENGLISH_TERMS,
) -> DataFrame:
    """``extracted_terms``: by language, Chinese rules, English rules or both."""
    kb = kb or Knowledge()
    text = F.col(text_col)
    tag = F.col(language_col) if language_col else F.lit("auto")
    zh, en = chinese_terms(text, kb), english_terms(text, english)
    is_zh = (tag == "zh") | ((tag == "auto") & contains_cjk(text))
    terms = F.when(is_zh, zh).when(tag == "en", en).otherwise(F.concat(zh, en))
    return barrier(df, extracted_terms=terms.cast(TERMS))


def term_rows(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(id_col, F.posexplode("extracted_terms").alias("ordinal", "t")).select(id_col, "ordinal", "t.*")


def find_positions(text: Column, term: Column) -> Column:
    """Start offsets (from 0) of all occurrences, overlapping ones included."""

    @F.pandas_udf("array<int>")
    def positions(texts: pd.Series, terms: pd.Series) -> pd.Series:
        def of(found: str | None, word: str | None) -> list[int] | None:
            if found is None or word is None:
                return None
            out, at = [], found.find(word) if word else -1
            while at >= 0:
                out.append(at)
                at = found.find(word, at + 1)
            return out

        return pd.Series(list(map(of, texts, terms)), dtype=object)

    return positions(text, term)


_BLANKS = "".join(c for c in map(chr, range(0x3001)) if unicodedata.category(c)[0] == "Z" or c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85")


def windows_around(text: Column, words: Column, radius: int, floor: int | None = None) -> Column:
    """For each of ``words`` the trimmed text around it, null where it does not occur.

    With ``floor`` that is the longest window around any occurrence, the first
    on ties, and longer than ``floor``; without, the window of the first one. A
    text is searched once per word and never copied.
    """
    @F.arrow_udf("array<string>")
    def windows(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return window_batches(batches, radius, floor)

    return windows(text, words)


def window_batches(batches: Iterator[tuple[pa.Array, pa.Array]], radius: int, floor: int | None) -> Iterator[pa.Array]:
    """The lists of windows for batches of texts and words, ``WINDOW_ROWS`` rows at a time.

    The windows of a batch may be many times its texts; those of a few rows stay small.
    """
    def around(found: str, word: str) -> str | None:
        best, at = None, found.find(word) if word else -1
        while at >= 0:
            begin, end = max(at - radius, 0), at + len(word) + radius
            window = found[begin:end].strip(_BLANKS)
            if floor is None:
                return window
            if len(window) > (floor if best is None else len(best)):
                best = window
                if len(window) == len(word) + 2 * radius:
                    break
            at = found.find(word, at + 1)
        return best

    for texts, lists in batches:
        for at in range(0, len(texts), WINDOW_ROWS):
            rows = zip(texts.slice(at, WINDOW_ROWS).to_pylist(), lists.slice(at, WINDOW_ROWS).to_pylist())
            yield pa.array([None if t is None or w is None else [around(t, x) for x in w] for t, w in rows], pa.list_(pa.string()))


ANSWER_RADIUS, ANSWER_FLOOR, FACT_RADIUS = 100, 20, 50


def pair_windows(text: Column, terms: Column, facts: Column) -> Column:
    """``terms`` and ``facts``: the windows around both by one worker, which gets each text once."""

    @F.arrow_udf("struct<terms:array<string>,facts:array<string>>")
    def windows(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return pair_window_batches(batches)

    return windows(text, terms, facts)


def pair_window_batches(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, terms, facts in batches:
        by_term = window_batches(iter([(texts, terms)]), ANSWER_RADIUS, ANSWER_FLOOR)
        by_fact = window_batches(iter([(texts, facts)]), FACT_RADIUS, None)
        for found in zip(by_term, by_fact):
            yield pa.StructArray.from_arrays(found, names=["terms", "facts"])


def answer_window(text: Column, term: Column, default: Column, radius: int = ANSWER_RADIUS, floor: int = ANSWER_FLOOR) -> Column:
    """Longest trimmed window around an occurrence, the first on ties."""
    return F.coalesce(F.get(windows_around(text, F.array(term), radius, floor), F.lit(0)), default)


def domain_of(term: Column) -> Column:
    out = None
    for name, domain in V.TERM_DOMAINS.items():
        out = F.when(term == name, domain) if out is None else out.when(term == name, domain)
    return out.otherwise(F.lit(V.DEFAULT_DOMAIN))


def context_of(text: Column, limit: int | None = 200) -> Column:
    """The head of a text; the whole of it without ``limit``."""
    if limit is None:
        return text
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("..."))).otherwise(text)


def _first(items: Column, n: int | None) -> Column:
    return items if n is None else F.slice(items, F.lit(1), F.lit(n))


def template_qa(
    text: Column, names: Column, key: Column, first: int | None = None, context: int | None = None, windows: Column | None = None
) -> Column:
    """Questions for the terms, or the ``first`` of them; type, template and partner picked by hash.

    ``windows`` are those around the terms if they are known.
    """
    if windows is None:
        windows = windows_around(text, _first(names, first), ANSWER_RADIUS, ANSWER_FLOOR)
    pairs = let(F.struct(names.alias("n"), windows.alias("w")), lambda s: _template_pairs(s["n"], s["w"], key, first))
    # Each binding copies what it gives, so the text joins the pairs last.
    return F.transform(pairs, lambda q: F.struct(
        q["ordinal"].alias("ordinal"),
        q["question"].alias("question"),
        q["answer"].alias("answer"),
        context_of(text, context).alias("context"),
        q["domain"].alias("domain"),
        F.lit(0.8).alias("confidence"),
        F.lit("template").alias("method"),
    ).cast(QA_FIELDS))


def _template_pairs(names: Column, windows: Column, key: Column, first: int | None) -> Column:
    kinds = list(V.QA_TEMPLATES)
    templates = F.array(*[F.array(*[F.lit(t) for t in V.QA_TEMPLATES[k]]) for k in kinds])
    defaults = F.array(*[F.lit(V.DEFAULT_ANSWERS[k]) for k in kinds])
    comparison = len(kinds) - 1

    def pair(term: Column, i: Column) -> Column:
        bound = F.struct(F.concat_ws("|", key, term).alias("seed"), F.filter(names, lambda n: n != term).alias("partners"))
        return let(bound, lambda b: seeded(term, i, b["seed"], b["partners"]))

    def seeded(term: Column, i: Column, seed: Column, partners: Column) -> Column:
        # The comparison type needs a second term.
        kind = hash_pick(seed, F.when(F.size(partners) > 0, len(kinds)).otherwise(comparison))

        def fill(k: Column) -> Column:
            template = F.get(F.get(templates, k), hash_pick(F.concat(seed, F.lit("|t")), 3))
            other = F.get(partners, hash_pick(F.concat(seed, F.lit("|o")), F.greatest(F.size(partners), F.lit(1))))
            question = F.replace(F.replace(template, F.lit("{term}"), term), F.lit("{other}"), F.coalesce(other, F.lit("")))
            default = F.replace(F.get(defaults, k), F.lit("{term}"), term)
            return F.struct(
                i.cast("int").alias("ordinal"),
                question.alias("question"),
                F.coalesce(F.get(windows, i), default).alias("answer"),
                domain_of(term).alias("domain"),
            )

        return let(kind, fill)

    return F.transform(_first(names, first), pair)


def fact_pattern() -> str:
    return rf"{NUMBER}[{BLANK}]*(?:{'|'.join(V.FACT_UNITS)})"


def facts_of(text: Column, first: int | None = None) -> Column:
    """The measurements of a text, or the ``first`` of them."""
    return _first(find_all(text, fact_pattern()), first)


def numeric_qa(text: Column, first: int | None = None, radius: int = FACT_RADIUS, windows: Column | None = None) -> Column:
    """Questions about the measurements, or the ``first`` of them, with the text around each.

    ``windows`` are those around the measurements if they are known.
    """
    facts = facts_of(text, first)
    sentences = windows_around(text, facts, radius) if windows is None else windows

    def pair(fact: Column, sentence: Column, i: Column) -> Column:
        return F.struct(
            i.cast("int").alias("ordinal"),
            F.replace(F.lit(V.FACT_QUESTION), F.lit("{fact}"), fact).alias("question"),
            F.replace(F.lit(V.FACT_ANSWER), F.lit("{sentence}"), sentence).alias("answer"),
            sentence.alias("context"),
            F.lit(V.FACT_DOMAIN).alias("domain"),
            F.lit(0.7).alias("confidence"),
            F.lit("content").alias("method"),
        ).cast(QA_FIELDS)

    return F.transform(F.arrays_zip(facts.alias("f"), sentences.alias("s")), lambda x, i: pair(x["f"], x["s"], i))


@dataclass(frozen=True)
class Limits:
    """How much of a chunk becomes questions; None sets no limit."""

    terms: int | None = None
    facts: int | None = None
    context: int | None = None
    per_chunk: int | None = None


# The limits of the domain toolkit.
SHORT = Limits(terms=3, facts=2, context=200, per_chunk=5)


def generate_qa(
    df: DataFrame, id_col: str, text_col: str = "content", limits: Limits = Limits(), model_qa: str | None = None
) -> DataFrame:
    """``generated_qa``: template, then caller's model pairs, then numeric facts."""
    names = F.transform(F.col("extracted_terms"), lambda t: t["term"])
    text = F.col(text_col)
    key = F.col(id_col).cast("string")
    around = pair_windows(text, _first(names, limits.terms), facts_of(text, limits.facts))
    found = template_qa(text, names, key, limits.terms, limits.context, around["terms"])
    model = [F.col(model_qa).cast(QA)] if model_qa else []
    pairs = F.concat(found, *model, numeric_qa(text, limits.facts, windows=around["facts"]))
    return barrier(df, generated_qa=_first(pairs, limits.per_chunk))


def limit_per_chunk(qa: DataFrame, id_col: str, n: int) -> DataFrame:
    """First ``n`` pairs of each chunk for pairs kept as rows."""
    rank = F.when(F.col("method") == "template", 0).when(F.col("method") == "model", 1).otherwise(2)
    order = Window.partitionBy(id_col).orderBy(rank, "ordinal")
    return qa.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def explode_qa(df: DataFrame, id_col: str) -> DataFrame:
    """One row per pair with all its fields."""
    rows = df.select(id_col, F.posexplode("generated_qa").alias("position", "qa"))
    return rows.select(id_col, "position", *[F.col(f"qa.{f}").alias(f) for f in
                       ("question", "answer", "context", "domain", "confidence", "method")])


def enrich(text: Column, terms: Column, explanations: dict[str, str] = V.EXPLANATIONS) -> Column:
    """Put the explanation in brackets after every bare occurrence of a found term."""

    @F.arrow_udf("string")
    def explained(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return explained_batches(batches, explanations)

    wanted = F.filter(terms, lambda t: (t["type"] == V.TERM_TYPES["term"]) & t["term"].isin(list(explanations)))
    return explained(text, F.transform(wanted, lambda t: t["term"]))


def explained_batches(batches: Iterator[tuple[pa.Array, pa.Array]], explanations: dict[str, str]) -> Iterator[pa.Array]:
    """The explained texts for batches of texts and found terms, ``WINDOW_ROWS`` rows at a time."""
    steps = [(t, t + e, re.compile(re.escape(t) + "(?!（)"), f"{t}（{e}）".replace("\\", r"\\")) for t, e in explanations.items()]

    def of(text: str | None, found: list[str] | None) -> str | None:
        for term, present, bare, explained in steps if text and found else ():
            if term in found and present not in text:
                text = bare.sub(explained, text)
        return text

    for texts, lists in batches:
        for at in range(0, len(texts), WINDOW_ROWS):
            rows = zip(texts.slice(at, WINDOW_ROWS).to_pylist(), lists.slice(at, WINDOW_ROWS).to_pylist())
            yield pa.array([of(t, f) for t, f in rows], pa.string())


def domain_tags(text: Column) -> Column:
    tags = [F.when(contains_any(text, words), F.lit(name)) for name, words in V.DOMAIN_KEYWORDS.items()]
    return F.array_compact(F.array(*tags))


def enhance(
    df: DataFrame,
    id_col: str,
    text_col: str = "content",
    *,
    language_col: str | None = None,
    kb: Knowledge | None = None,
    with_terms: bool = True,
    with_qa: bool = True,
    with_enrichment: bool = True,
    limits: Limits = Limits(),
) -> DataFrame:
    """Whole enhancement order; domain tags read the enriched text."""
    if with_terms:
        df = extract_terms(df, text_col, language_col, kb)
    else:
        df = df.withColumn("extracted_terms", F.array().cast(TERMS))
    if with_enrichment:
        # Before the pairs, which are many times the text.
        df = barrier(df, enriched=_enriched(df, text_col))
    if with_qa:
        df = generate_qa(df, id_col, text_col, limits)
    if with_enrichment:
        df = df.withColumn("knowledge_enriched", F.col("enriched") != F.col(text_col))
        df = df.withColumn("original_content", F.when(F.col("knowledge_enriched"), F.col(text_col)))
        df = df.withColumn(text_col, F.col("enriched")).drop("enriched")
    return df.withColumn("domain_tags", domain_tags(F.col(text_col))).withColumn("enhanced", F.lit(True))


def _enriched(df: DataFrame, text_col: str) -> Column:
    return enrich(df[text_col], df["extracted_terms"])


def update_kb(kb: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Upsert: rows of ``new`` replace rows of ``kb`` with the same key."""
    return kb.join(new, key, "left_anti").unionByName(new, allowMissingColumns=True)


def enhance_stats(df: DataFrame, kb: Knowledge | None = None) -> DataFrame:
    kb = kb or Knowledge()
    return df.agg(
        F.coalesce(F.sum(F.size("generated_qa")), F.lit(0)).alias("generated_qa_count"),
        F.coalesce(F.sum(F.size("extracted_terms")), F.lit(0)).alias("extracted_terms_count"),
        F.lit(len(kb.terms)).cast("long").alias("knowledge_base_terms"),
        F.lit(len(kb.entities)).cast("long").alias("knowledge_base_entities"),
    )
