"""Column expressions shared by the text operators.

Patterns are kept in a form that Java and RE2 read alike: explicit classes
instead of ``\\w``, ``\\s`` and ``\\b``, whose meaning differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode blanks, as a class body.
BLANK = r"\p{Z}\t-\r\x{1C}-\x{1F}\x{85}"
# The same one by one.
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
WORD = rf"[^{BLANK}]+"
DIGIT = r"\p{Nd}"
NUMBER = rf"{DIGIT}+(?:\.{DIGIT}+)?"
CJK = r"\x{4E00}-\x{9FFF}"
CJK_RUN = rf"[{CJK}]+"
WORD_CHARS = r"[\p{L}\p{N}_]+"
CJK_OR_LATIN = rf"[{CJK}]+|[a-zA-Z]+"
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^{BLANK}\p{{L}}\p{{N}}_]"
SENTENCE_MARK = r"[.!?。！？]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A lambda that mentions an outer expression re-evaluates it for every
    element; binding it first keeps such bodies linear.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def barrier(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters cannot be pushed through.

    Catalyst copies a projected expression into every predicate above it.
    Predicates on generator output stay above the generator, so a costly
    expression is evaluated once per row.
    """
    alias = "_bound"
    packed = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(packed))) if columns else df.alias(alias)


def strip(text: Column) -> Column:
    """Remove Unicode blanks at both ends; only the ends are looked at."""
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{BLANK}]")


def replace_if(text: Column, literals: str | list[str], pattern: str, replacement: str) -> Column:
    """``regexp_replace`` for texts that hold one of ``literals``, of which every match needs one."""
    needed = [literals] if isinstance(literals, str) else literals
    return let(
        text,
        lambda t: F.when(contains_any(t, needed), F.regexp_replace(t, pattern, replacement)).otherwise(t),
    )


def find_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def words_of(text: Column) -> Column:
    return find_all(text, WORD)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def count_if(text: Column, literals: list[str], pattern: str) -> Column:
    """``count_of`` for texts that hold one of ``literals``, of which every match needs one."""
    return F.when(contains_any(text, literals), count_of(text, pattern)).when(text.isNotNull(), F.lit(0))


def chars_of(text: Column) -> Column:
    return F.split(text, "")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` with 0 for an empty whole; both are evaluated once."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.coalesce(share, F.when(whole.isNotNull(), F.lit(0.0)))


def size_where(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(items, test))


def total_length(items: Column) -> Column:
    return F.length(F.array_join(items, ""))


def contains_cjk(text: Column) -> Column:
    return text.rlike(f"[{CJK}]")


def contains_any(text: Column, needles: list[str]) -> Column:
    """True if any of the literal strings occurs.

    Byte searches in turn; for short lists that beats one alternation.
    """
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in needles])


def quote(literal: str) -> str:
    """Escape a literal for both Java and RE2 patterns."""
    special = set("\\.^$|?*+()[]{}-&~#")
    return "".join("\\" + c if c in special else c for c in literal)


def run_lengths(sorted_items: Column) -> Column:
    """Length of every run of equal neighbours in a sorted array."""

    def measure(items: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(items)),
            lambda i: (i == 1) | (F.get(items, i - 1) != F.get(items, i - 2)),
        )
        return let(
            starts,
            lambda s: F.transform(
                s, lambda p, j: F.coalesce(F.get(s, j + 1), F.size(items) + 1) - p
            ),
        )

    empty = F.array().cast("array<int>")
    return let(sorted_items, lambda x: F.when(F.size(x) > 0, measure(x)).otherwise(empty))


def numbered(items: Column) -> Column:
    """Turn a multiset into a set: the n-th copy of ``x`` becomes ``x#n``."""

    def label(x: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(x)),
            lambda i: (i == 1) | (F.get(x, i - 1) != F.get(x, i - 2)),
        )
        return let(
            starts,
            lambda s: F.flatten(
                F.transform(
                    s,
                    lambda p, j: F.transform(
                        F.sequence(F.lit(1), F.coalesce(F.get(s, j + 1), F.size(x) + 1) - p),
                        lambda n: F.concat(F.get(x, p - 1), F.lit("#"), n.cast("string")),
                    ),
                )
            ),
        )

    empty = F.array().cast("array<string>")
    return let(F.array_sort(items), lambda x: F.when(F.size(x) > 0, label(x)).otherwise(empty))


def ngrams(items: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring items, joined by one blank.

    Shifted copies are zipped, so no element lookup by position is needed.
    """
    empty = F.array().cast("array<string>")

    def joined(x: Column) -> Column:
        count = F.size(x) - (n - 1)
        grams = F.slice(x, F.lit(1), count)
        for shift in range(1, n):
            grams = F.zip_with(
                grams, F.slice(x, F.lit(shift + 1), count), lambda a, b: F.concat(a, F.lit(" "), b)
            )
        return grams

    return let(items, lambda x: F.when(F.size(x) >= n, joined(x)).otherwise(empty))


def hashed_ngrams(items: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` neighbouring items; like ``ngrams`` without the strings."""
    empty = F.array().cast("array<bigint>")

    def mixed(h: Column) -> Column:
        count = F.size(h) - (n - 1)
        grams = F.slice(h, F.lit(1), count)
        for shift in range(1, n):
            grams = F.zip_with(grams, F.slice(h, F.lit(shift + 1), count), lambda a, b: F.xxhash64(a, b))
        return grams

    return let(
        F.transform(items, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) >= n, mixed(h)).otherwise(empty)
    )


def truncate(text: Column, limit: int = 100, suffix: str = "...") -> Column:
    """Cut to ``limit`` characters, the suffix included."""
    return F.when(
        F.length(text) > limit, F.concat(F.left(text, F.lit(limit - len(suffix))), F.lit(suffix))
    ).otherwise(text)


def format_size(size: Column) -> Column:
    """Byte count with a unit, one decimal; zero is ``0B``."""
    value = size.cast("double")
    # Half-even first: the formatter alone would round ties up.
    shown = lambda v: F.format_string("%.1f", F.bround(v, 1))
    out = F.when(size == 0, F.lit("0B"))
    for power, unit in enumerate(["B", "KB", "MB", "GB"]):
        out = out.when(
            value < 1024.0 ** (power + 1),
            F.concat(shown(value / (1024.0**power)), F.lit(unit)),
        )
    return out.otherwise(F.concat(shown(value / 1024.0**4), F.lit("TB")))


def hash_pick(key: Column, n: Column | int) -> Column:
    """Repeatable choice in ``0..n-1`` from the md5 of ``key``."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.conv(F.left(F.md5(key), F.lit(6)), 16, 10).cast("int") % n
