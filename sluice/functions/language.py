"""Language labels from script shares and stop-word counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import CJK, WORD_CHARS, count_of, find_all, let, ratio, size_where

# Frequent function words, one list per language; each word is in one list only.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "is", "that", "it", "for", "with", "this", "are", "was", "you", "by", "have"],
    "de": ["der", "die", "und", "das", "nicht", "ein", "eine", "ist", "mit", "auf", "von", "zu", "den", "dem", "auch"],
    "fr": ["le", "les", "des", "et", "dans", "qui", "pour", "sur", "est", "du", "une", "au", "par", "pas", "avec"],
    "es": ["el", "los", "las", "y", "que", "en", "por", "con", "para", "del", "se", "como", "su", "lo", "al"],
}
CJK_SHARE = 0.3


def detect_language(text: Column, sample_chars: int | None = None) -> Column:
    """``zh``, ``en``, ``de``, ``fr``, ``es`` or ``unknown``.

    Whole texts by default; ``sample_chars`` looks at the head only, as a
    cheaper setting for very long rows.
    """
    seen = text if sample_chars is None else F.left(text, F.lit(sample_chars))
    letters = count_of(seen, r"\p{L}")
    cjk_share = ratio(count_of(seen, f"[{CJK}]"), letters)

    def best(words: Column) -> Column:
        def hits_of(stops: list[str]) -> Column:
            return size_where(words, lambda w: w.isin(stops))

        hits = F.struct(*[hits_of(stops).alias(k) for k, stops in STOP_WORDS.items()])

        def argmax(h: Column) -> Column:
            top = F.greatest(*[h[k] for k in STOP_WORDS])
            out = F.when(top == 0, F.lit("unknown"))
            for name in STOP_WORDS:
                out = out.when(h[name] == top, F.lit(name))
            return out

        return let(hits, argmax)

    return F.when(cjk_share >= CJK_SHARE, F.lit("zh")).otherwise(
        let(find_all(F.lower(seen), WORD_CHARS), best)
    )


def language_tag(text: Column, sample_chars: int | None = None) -> Column:
    """Chunk language: ``zh``, ``en`` or ``auto``."""
    return let(
        detect_language(text, sample_chars),
        lambda label: F.when(label.isin("zh", "en"), label).otherwise(F.lit("auto")),
    )
