"""Text refiners and heuristic filters for pretraining and instruction text.

A predicate takes a ``View`` (text, words and lines of one column) and returns
a boolean column: keep the row or not. ``keep`` applies any number of them in
one pass; words and lines are computed once per row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.language import detect_language
from sluice.functions.text import (
    BLANK,
    SENTENCE_MARK,
    WORD,
    WORD_CHARS,
    barrier,
    contains_any,
    count_if,
    count_of,
    find_all,
    let,
    lines_of,
    ratio,
    replace_if,
    size_where,
    strip,
    total_length,
    words_of,
)

EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{FE0F}\x{1F1E6}-\x{1F1FF}]"
HTML_ENTITY = r"&?(?:nbsp|lt|gt|amp|quot|apos|hellip|ndash|mdash|lsquo|rsquo|ldquo|rdquo);"
ODD_CHARACTER = r"[\x{FFFD}\x{200B}-\x{200F}\x{2028}\x{2029}\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}]"
ID_NUMBER = r"\b[0-9]{17}[0-9Xx]\b|\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b|(?i:id card|identity card|id number|身份证)"
BULLET_LINE = rf"\A[{BLANK}]*[•●■◦‣*-]"


@dataclass(frozen=True)
class View:
    text: Column
    words: Column
    lines: Column


Predicate = Callable[[View], Column]


def view_of(text: Column) -> View:
    return View(text, words_of(text), lines_of(text))


# ---- refiners ---------------------------------------------------------------


def remove_extra_spaces(text: Column) -> Column:
    # A run that is one plain blank stays as it is.
    return strip(F.regexp_replace(text, f"[{BLANK}&&[^ ]][{BLANK}]*| [{BLANK}]+", " "))


def remove_emoji(text: Column) -> Column:
    # Texts of one byte a character have none.
    return let(text, lambda t: F.when(F.octet_length(t) > F.length(t), F.regexp_replace(t, EMOJI, "")).otherwise(t))


def remove_html_url(text: Column) -> Column:
    links = replace_if(text, "://", rf"https?://[^{BLANK}<>\"]+", "")
    return replace_if(links, "<", r"<[^<>]+>", "")


# ---- predicates -------------------------------------------------------------


def blocklist(words: list[str], allowed: int = 1) -> Predicate:
    """At most ``allowed`` distinct listed words. The list is a parameter of bounded size."""
    listed = sorted({w.lower() for w in words})
    if len(listed) > 50_000:
        raise ValueError("pass long lists as a table to blocklist_join")
    literal = F.array(*[F.lit(w) for w in listed])
    return lambda v: let(
        F.array_distinct(find_all(F.lower(v.text), WORD_CHARS)),
        lambda w: F.size(F.array_intersect(w, literal)) <= allowed,
    )


def blocklist_join(df: DataFrame, id_col: str, text_col: str, words: DataFrame, allowed: int = 1) -> DataFrame:
    """The same test with the list as a table of any size (column ``word``)."""
    tokens = df.select(id_col, F.explode(F.array_distinct(find_all(F.lower(text_col), WORD_CHARS))).alias("word"))
    listed = words.select(F.lower("word").alias("word")).distinct()
    bad = tokens.join(listed, "word", "left_semi").groupBy(id_col).count().filter(F.col("count") > allowed)
    return df.join(bad.select(id_col), id_col, "left_anti")


def word_number(low: int = 20, high: int = 100_000) -> Predicate:
    return lambda v: (F.size(v.words) >= low) & (F.size(v.words) < high)


def colon_end() -> Predicate:
    return lambda v: ~v.text.rlike(rf"[:：][{BLANK}]*\z")


def sentence_number(low: int = 3, high: int = 7500) -> Predicate:
    # One part more than there are runs of marks.
    return lambda v: (F.size(F.split(v.text, SENTENCE_MARK)) - 1).between(low, high)


def line_end_with_ellipsis(limit: float = 0.3) -> Predicate:
    return lambda v: ratio(size_where(v.lines, lambda s: s.rlike(rf"(?:\.\.\.|…)[{BLANK}]*\z")), F.size(v.lines)) <= limit


def content_null() -> Predicate:
    return lambda v: v.text.isNotNull() & (strip(v.text) != "")


def mean_word_length(low: float = 3, high: float = 10) -> Predicate:
    def test(v: View) -> Column:
        mean = ratio(total_length(v.words), F.size(v.words))
        return (mean >= low) & (mean < high)

    return test


def symbol_word_ratio(limit: float = 0.4) -> Predicate:
    return lambda v: ratio(count_if(v.text, ["#", "...", "…"], r"#|\.\.\.|…"), F.size(v.words)) < limit


def html_entity() -> Predicate:
    return lambda v: ~(F.contains(v.text, F.lit(";")) & v.text.rlike(HTML_ENTITY))


def no_punc(limit: int = 112) -> Predicate:
    """Longest stretch without a sentence mark, in words; more words than the limit need more than twice as many characters."""
    def test(v: View) -> Column:
        long = F.filter(F.split(v.text, SENTENCE_MARK), lambda s: F.length(s) > 2 * limit)
        return F.coalesce(F.array_max(F.transform(long, lambda s: count_of(s, WORD))), F.lit(0)) <= limit

    return test


def special_character() -> Predicate:
    # Plain characters are told first.
    return lambda v: ~v.text.rlike(f"[[^ -~]&&{ODD_CHARACTER}]")


def watermark(marks: list[str] = V.WATERMARKS) -> Predicate:
    return lambda v: ~contains_any(v.text, marks)


def curly_bracket(limit: float = 0.025) -> Predicate:
    return lambda v: ratio(count_if(v.text, ["{", "}"], r"[{}]"), F.length(v.text)) < limit


def capital_words(limit: float = 0.2) -> Predicate:
    return lambda v: ratio(size_where(v.words, lambda w: (w == F.upper(w)) & (w != F.lower(w))), F.size(v.words)) <= limit


def lorem_ipsum(limit: float = 3e-8) -> Predicate:
    return lambda v: ratio(count_of(v.text, "(?i)lorem ipsum"), F.length(v.text)) <= limit


def unique_words(limit: float = 0.1) -> Predicate:
    return lambda v: ratio(
        F.size(F.array_distinct(F.transform(v.words, F.lower))), F.size(v.words)
    ) > limit


def char_number(low: int = 100) -> Predicate:
    # Words are all that is not blank.
    return lambda v: total_length(v.words) >= low


def line_start_with_bullet(limit: float = 0.9) -> Predicate:
    return lambda v: ratio(size_where(v.lines, lambda s: s.rlike(BULLET_LINE)), F.size(v.lines)) <= limit


def line_with_javascript(limit: int = 3) -> Predicate:
    return lambda v: size_where(v.lines, lambda s: F.contains(F.lower(s), F.lit("javascript"))) < limit


def id_card(limit: int = 3) -> Predicate:
    return lambda v: count_of(v.text, ID_NUMBER) < limit


def language(allowed: list[str]) -> Predicate:
    return lambda v: detect_language(v.text).isin(allowed)


def keep(df: DataFrame, text_col: str, *predicates: Predicate) -> DataFrame:
    """Rows that pass every predicate, in one scan."""
    return label(df, text_col, **{f"_p{i}": p for i, p in enumerate(predicates)}).filter(
        " AND ".join(f"_p{i}" for i in range(len(predicates))) or "true"
    ).drop(*[f"_p{i}" for i in range(len(predicates))])


def label(df: DataFrame, text_col: str, **predicates: Predicate) -> DataFrame:
    """One boolean column per predicate, all rows kept."""
    text = F.col(text_col)
    df = barrier(df, _words=words_of(text), _lines=lines_of(text))
    view = View(text, F.col("_words"), F.col("_lines"))
    flags = {name: F.coalesce(p(view), F.lit(False)) for name, p in predicates.items()}
    return barrier(df, **flags).drop("_words", "_lines")


def score_band(df: DataFrame, score: str | Column, low: float, high: float) -> DataFrame:
    """Keep scores inside a closed band; null scores go."""
    score = F.col(score) if isinstance(score, str) else score
    return df.filter(score.between(low, high))


def join_score_band(df: DataFrame, scores: DataFrame, key: str, score: str, low: float, high: float) -> DataFrame:
    """Band filter on scores kept in their own table; rows without a score go."""
    good = scores.filter(F.col(score).between(low, high)).select(key)
    return df.join(good, key, "left_semi")
