"""Filters for source-code records.

Each test adds an integer label (1 keep, 0 drop); ``code_filters`` adds all
labels in one pass and keeps the rows with every label at 1.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import (
    barrier,
    count_of,
    find_all,
    hashed_ngrams,
    let,
    lines_of,
    ratio,
    run_lengths,
    size_where,
    total_length,
    words_of,
)

GENERATED_MARKS = r"(?i)auto-generated|autogenerated|do not edit|generated by"
ENCODED = {
    "base64": r"[A-Za-z0-9+/]{40,}={0,2}",
    "hex": r"(?:\b0x[0-9A-Fa-f]{2}\b[, ]*){8,}",
    "unicode": r"(?:\\u[0-9A-Fa-f]{4}){8,}",
}
TEXT_TYPES = ["text", "txt", "markdown", "md", "html", "htm", "xml", "rst", "css"]
TEXT_NAMES = ["readme", "notes", "todo", "license", "requirements", "description"]
OPERATORS = {
    "greater": ">", "greater_equal": ">=", "less": "<", "less_equal": "<=", "equal": "=", "not_equal": "!=",
}


@dataclass(frozen=True)
class DocumentLimits:
    min_num_chars: int = 100
    max_num_chars: int = 100_000
    min_num_words: int = 10
    max_num_words: int = 50_000
    max_frac_duplicate_lines: float = 0.3
    max_frac_duplicate_2gram: float = 0.3
    max_frac_duplicate_3gram: float = 0.3
    max_frac_duplicate_4gram: float = 0.3
    max_frac_duplicate_5gram: float = 0.3
    max_frac_curly_bracket: float = 0.1
    max_frac_all_caps_words: float = 0.3
    min_entropy_unigram: float = 2.0


def auto_generated(lines: Column, head: int | None = 5) -> Column:
    """No generator notice in the first ``head`` lines, or in any without it."""
    some = lines if head is None else F.slice(lines, F.lit(1), F.lit(head))
    return ~F.exists(some, lambda s: s.rlike(GENERATED_MARKS))


def length_sample(lines: Column, max_lines: int = 100_000, max_mean: float = 100, max_line: int = 1000) -> Column:
    longest = F.coalesce(F.array_max(F.transform(lines, lambda s: F.length(s))), F.lit(0))
    return (
        (F.size(lines) <= max_lines)
        & (ratio(total_length(lines), F.size(lines)) <= max_mean)
        & (longest <= max_line)
    )


def text_composition(text: Column, min_alnum: float = 0.25) -> Column:
    alnum = ratio(count_of(text, r"[\p{L}\p{N}]"), F.length(text))
    return (alnum >= min_alnum) & ~text.rlike(r"\x{00}")


def encoded_data(text: Column, max_share: float = 0.5, max_run: int = 1024) -> Column:
    """No kind of encoded run covers half of the text, and none is very long."""
    tests = []
    for pattern in ENCODED.values():
        tests.append(let(
            F.transform(find_all(text, pattern), lambda r: F.length(r)),
            lambda runs: (F.coalesce(F.array_max(runs), F.lit(0)) <= max_run)
            & (ratio(F.aggregate(runs, F.lit(0), lambda a, b: a + b), F.length(text)) < max_share),
        ))
    return tests[0] & tests[1] & tests[2]


def duplicate_share(items: Column) -> Column:
    return let(items, lambda x: F.lit(1.0) - ratio(F.size(F.array_distinct(x)), F.size(x)))


def duplicate_or_empty(items: Column) -> Column:
    """Duplicate share, 0 where there is nothing to repeat."""
    return let(items, lambda x: F.when(F.size(x) == 0, F.lit(0.0)).otherwise(duplicate_share(x)))


def unigram_entropy(words: Column) -> Column:
    """Entropy of the word distribution in nats, within the row."""

    def entropy(counts: Column) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c)
        logs = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * F.log(c.cast("double")))
        return F.when(F.size(counts) == 0, F.lit(0.0)).otherwise(
            F.log(F.greatest(n, F.lit(1.0))) - logs / F.greatest(n, F.lit(1.0))
        )

    return let(run_lengths(F.array_sort(words)), entropy)


def document_quality(text: Column, words: Column, lines: Column, limits: DocumentLimits = DocumentLimits()) -> Column:
    caps = ratio(size_where(words, lambda w: (w == F.upper(w)) & (w != F.lower(w))), F.size(words))
    test = (
        F.length(text).between(limits.min_num_chars, limits.max_num_chars)
        & F.size(words).between(limits.min_num_words, limits.max_num_words)
        & (duplicate_or_empty(lines) <= limits.max_frac_duplicate_lines)
        & (ratio(count_of(text, r"[{}]"), F.length(text)) <= limits.max_frac_curly_bracket)
        & (caps <= limits.max_frac_all_caps_words)
    )
    for n in (2, 3, 4, 5):
        limit = getattr(limits, f"max_frac_duplicate_{n}gram")
        test = test & (duplicate_or_empty(hashed_ngrams(words, n)) <= limit)
    return test & (unigram_entropy(words) >= limits.min_entropy_unigram)


def file_type_content(
    filetype: Column, filename: Column, visible: Column, total: Column,
    min_visible: int = 100, min_share: float = 0.2,
) -> Column:
    """Markup needs visible text; plain text needs a name that promises content."""
    kind = F.lower(filetype)
    stem = F.regexp_replace(F.lower(filename), r"\.[^.]*\z", "")
    markup = kind.isin("html", "htm", "xml")
    plain = kind.isin("text", "txt", "markdown", "md", "rst")
    return (
        F.when(markup, (visible >= min_visible) & (ratio(visible, total) >= min_share))
        .when(plain, F.coalesce(stem.isin(TEXT_NAMES), F.lit(False)))
        .otherwise(F.lit(True))
    )


def generic_score(df: DataFrame, score: str, threshold: float, method: str = "greater_equal") -> DataFrame:
    if method not in OPERATORS:
        raise ValueError(f"unknown comparison: {method}")
    return df.filter(F.expr(f"`{score}` {OPERATORS[method]} {float(threshold)!r}D"))


def quality_score_band(df: DataFrame, score: str, low: float = 0, high: float = 10) -> DataFrame:
    return df.filter(F.col(score).between(low, high))


LABELS = ["autogen", "length", "composition", "encoded", "quality", "filetype"]


def code_labels(df: DataFrame, text_col: str = "text", lines_col: str | None = "lines",
                limits: DocumentLimits = DocumentLimits()) -> DataFrame:
    """All code labels as integer columns ``<name>_label``."""
    text = F.col(text_col)
    df = barrier(df, _words=words_of(text), _lines=F.col(lines_col) if lines_col else lines_of(text))
    words, lines = F.col("_words"), F.col("_lines")
    tests = {
        "autogen": auto_generated(lines),
        "length": length_sample(lines),
        "composition": text_composition(text),
        "encoded": encoded_data(text),
        "quality": document_quality(text, words, lines, limits),
    }
    if {"filetype", "filename", "visible_text_length", "total_code_length"} <= set(df.columns):
        tests["filetype"] = file_type_content(
            F.col("filetype"), F.col("filename"), F.col("visible_text_length"), F.col("total_code_length")
        )
    labels = {f"{n}_label": F.coalesce(t, F.lit(False)).cast("int") for n, t in tests.items()}
    return barrier(df, **labels).drop("_words", "_lines")


def code_filters(df: DataFrame, text_col: str = "text", lines_col: str | None = "lines", **options) -> DataFrame:
    out = code_labels(df, text_col, lines_col, **options)
    present = [f"{n}_label" for n in LABELS if f"{n}_label" in out.columns]
    return out.filter(" AND ".join(f"{c} = 1" for c in present))
