"""Cleaning: markup removal, blanks, punctuation, the quality gate and bookkeeping.

All steps are Column functions without state; ``clean`` puts them in order and
evaluates the cleaned text once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.text import (
    BLANK,
    CJK,
    CJK_RUN,
    DIGIT,
    barrier,
    chars_of,
    contains_any,
    contains_cjk,
    find_all,
    is_blank,
    let,
    quote,
    ratio,
    replace_if,
    strip,
)

# Applied in this order; each pair is (pattern, replacement).
URL = r"(?i)https?://[a-z!$-_]+"
EMAIL = r"(?i)\b[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z|]{2,}\b"
MARKUP = [(r"<[^>]+>", ""), (URL, ""), (EMAIL, "")]
# A match needs this literal; texts without it skip the pattern.
NEEDED = ["<", "://", "@"]
TAIL = [(r"[.!?]{3,}", "..."), (rf"({DIGIT})([a-zA-Z])", "$1 $2")]
END_MARKS = [a + b for a in ".!?" for b in ".!?"]


def normalize_newlines(text: Column) -> Column:
    return replace_if(text, "\r", "\r\n?", "\n")


def collapse_blanks(text: Column, keep_newlines: bool = False) -> Column:
    """Runs of blanks become one blank; optionally newlines stay (one per run)."""
    if keep_newlines:
        return replace_if(_plain_blanks(text), "\n\n", r"\n{2,}", "\n")
    return F.regexp_replace(text, f"[{BLANK}]+", " ")


def _plain_blanks(text: Column) -> Column:
    """Runs of blanks and tabs become one blank; only runs that are something else are touched."""
    return replace_if(text, ["  ", "\t"], r"[ \t]{2,}|\t", " ")


def strip_markup(text: Column) -> Column:
    """Remove tags, links and mail addresses."""
    for (pattern, replacement), literal in zip(MARKUP, NEEDED):
        text = replace_if(text, literal, pattern, replacement)
    return text


def collapse_marks(text: Column) -> Column:
    """Shorten runs of end marks and part digits from letters."""
    (marks, short), (digit, parted) = TAIL
    return F.regexp_replace(replace_if(text, END_MARKS, marks, short), digit, parted)


def ascii_punct(text: Column, normalize_quotes: bool = False) -> Column:
    """Full-width punctuation to ASCII, only in texts that hold CJK characters."""
    source, target = V.FULL_WIDTH, V.ASCII_FORM
    if normalize_quotes:
        source, target = source + "“”‘’", target + "\"\"''"
    return F.when(contains_cjk(text), F.translate(text, source, target)).otherwise(text)


def trim_ws(text: Column) -> Column:
    # After the first step a run is one blank.
    return strip(F.replace(F.replace(_plain_blanks(text), F.lit("\n "), F.lit("\n")), F.lit(" \n"), F.lit("\n")))


def basic_clean(text: Column, keep_newlines: bool = False, normalize_quotes: bool = False) -> Column:
    text = collapse_blanks(normalize_newlines(text), keep_newlines)
    text = collapse_marks(strip_markup(text))
    return trim_ws(let(text, lambda t: ascii_punct(t, normalize_quotes)))


def segment_marked(text: Column, dictionary: list[str]) -> Column:
    """Put ``\\u0001`` around every dictionary word, longest word first.

    This is dictionary matching, not statistical segmentation: what lies
    between two dictionary words stays one piece.
    """
    ordered = sorted(dictionary, key=lambda w: (-len(w), w))
    # Words are tried only where one may begin.
    begins = "" if "" in dictionary else "(?=[" + "".join(quote(c) for c in dict.fromkeys(w[0] for w in ordered)) + "])"
    return F.regexp_replace(text, begins + "(" + "|".join(quote(w) for w in ordered) + ")", "\x01$1\x01")


def filter_cjk_tokens(text: Column, protected: list[str] | None = None) -> Column:
    """Keep dictionary words, pieces longer than one character and end marks."""
    words = protected or V.PROTECTED_TERMS
    pieces = find_all(segment_marked(text, words), rf"{CJK_RUN}|[a-zA-Z]+|{DIGIT}+|[^\x{{01}}]")
    kept = F.filter(
        pieces, lambda w: w.isin(words) | (F.length(w) > 1) | w.isin(list(V.KEPT_MARKS))
    )
    return F.array_join(kept, "")


def filter_en_tokens(text: Column, stop_words: list[str]) -> Column:
    """Drop stop words and bare punctuation; words are joined by one blank."""
    tokens = find_all(text, rf"[\p{{L}}\p{{N}}_']+")
    return F.array_join(F.filter(tokens, lambda w: ~F.lower(w).isin(stop_words)), " ")


def strip_special(text: Column) -> Column:
    kept = rf"{CJK}\x{{3400}}-\x{{4DBF}}\p{{L}}\p{{N}}_{BLANK}.,;:!?()\[\]{{}}\"'-"
    return F.regexp_replace(text, f"[^{kept}]", "")


def fix_common(text: Column) -> Column:
    """Blanks around marks, thousands commas, blanks inside parentheses."""
    # Places that are as they should be do not match.
    text = F.regexp_replace(text, r" +([.,;:!?])", "$1")
    text = replace_if(text, "  ", r"([.,;:!?]) {2,}", "$1 ")
    text = replace_if(text, ",", rf"({DIGIT}),({DIGIT}{{3}})", "$1$2")
    text = replace_if(text, "(", rf"\([{BLANK}]+", "(")
    return replace_if(text, ")", rf"[{BLANK}]+\)", ")")


def quality_gate(text: Column, min_length: int = 10, marks: str = V.GATE_CHARACTERS) -> Column:
    """Long enough, varied enough, and either on topic or clearly rich."""

    # From the first character to the first far enough behind it; without such, what is left is short.
    too_short = ~text.rlike(rf"[^{BLANK}](?s:.{{{min_length - 2},}}?)[^{BLANK}]") if min_length > 1 else F.length(strip(text)) < min_length
    repetitive = ~_more_distinct(text, 4) & (F.length(text) > 20)
    on_topic = contains_any(text, list(marks))
    rich = (F.length(text) > 100) & _more_distinct(text, 30)
    return ~too_short & ~repetitive & (on_topic | rich)


def _more_distinct(text: Column, n: int) -> Column:
    """Has the text more than ``n`` different characters? Mostly its head has, and the rest is not taken apart."""

    def has(part: Column) -> Column:
        return F.size(F.array_distinct(chars_of(part))) > n

    short, long = 16 * n, 64 * n
    length = F.length(text)
    longer = has(F.left(text, F.lit(long))) | ((length > long) & has(text))
    return has(F.left(text, F.lit(short))) | ((length > short) & longer)


def with_clean_stats(df: DataFrame, original: str, cleaned: str, done: Column | None = None) -> DataFrame:
    before, after = F.length(original), F.length(cleaned)
    return df.select(
        "*",
        (F.lit(True) if done is None else done).alias("is_cleaned"),
        before.alias("original_length"),
        after.alias("cleaned_length"),
        ratio(after, before).alias("cleaning_ratio"),
    )


def clean(
    df: DataFrame,
    text_col: str = "content",
    *,
    language_col: str | None = None,
    min_length: int = 10,
    keep_newlines: bool = False,
    normalize_quotes: bool = False,
    remove_special: bool = False,
    protected: list[str] | None = None,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """Whole cleaning order for one text column.

    Adds ``cleaned``, ``passed_gate`` and the length columns. Token filters run
    only where asked for: ``protected`` for Chinese rows, ``stop_words`` for the
    others; rows of unknown language are routed by script.
    """
    text = basic_clean(F.col(text_col), keep_newlines, normalize_quotes)
    if protected or stop_words:
        tag = F.col(language_col) if language_col else F.lit("auto")

        def route(t: Column) -> Column:
            zh = filter_cjk_tokens(t, protected) if protected else t
            en = filter_en_tokens(t, stop_words) if stop_words else t
            both = filter_en_tokens(zh, stop_words) if stop_words else zh
            is_zh = (tag == "zh") | ((tag == "auto") & contains_cjk(t))
            is_en = (tag == "en") | ((tag == "auto") & ~contains_cjk(t))
            return F.when(is_zh, zh).when(is_en, en).otherwise(both)

        text = let(text, route)
    if remove_special:
        text = strip_special(text)
    text = fix_common(text)
    text = F.when(is_blank(F.col(text_col)), F.col(text_col)).otherwise(text)
    df = barrier(df, cleaned=text)
    df = df.withColumn("passed_gate", quality_gate(F.col("cleaned"), min_length))
    return with_clean_stats(df, text_col, "cleaned", F.coalesce("passed_gate", F.lit(False)))


def mark_status(df: DataFrame, duplicate_col: str | None = None, failed_col: str | None = None) -> DataFrame:
    """``status`` and ``skip_reason``; rows stay, a later step may drop them."""
    status, reason = F.lit("completed"), F.lit(None).cast("string")
    if duplicate_col:
        status = F.when(F.col(duplicate_col), F.lit("skipped")).otherwise(status)
        reason = F.when(F.col(duplicate_col), F.lit(V.DUPLICATE_REASON)).otherwise(reason)
    if failed_col:
        status = F.when(F.col(failed_col).isNotNull(), F.lit("failed")).otherwise(status)
        reason = F.coalesce(F.col(failed_col), reason)
    return df.select("*", status.alias("status"), reason.alias("skip_reason"))


def drop_skipped(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "completed")


def final_content(df: DataFrame, text_col: str = "content") -> DataFrame:
    """Cleaned text where the gate passed and the row was kept, else the original."""
    good = F.coalesce(F.col("passed_gate") & (F.col("status") == "completed"), F.lit(False))
    return df.withColumn(text_col, F.when(good, F.col("cleaned")).otherwise(F.col(text_col))).withColumn("is_cleaned", good)


def extend_protected(protected: DataFrame, new: DataFrame) -> DataFrame:
    return protected.unionByName(new).distinct()


def cleaning_stats(df: DataFrame, text_col: str = "cleaned", protected_count: int = len(V.PROTECTED_TERMS)) -> DataFrame:
    """Distinct texts seen, texts kept and size of the protected list, in one row."""
    return df.agg(
        F.count_distinct(F.md5(text_col)).alias("duplicate_hashes"),
        F.count_if(F.col("status") == "completed").alias("contents_stored"),
        F.lit(protected_count).cast("long").alias("protected_terms"),
    )
