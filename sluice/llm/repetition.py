"""Quality rules on repetition: rolling hashes of word n-grams, and repeated lines."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.workers import steps

# Share of word characters that may lie inside n-grams that repeat an earlier one, by length.
GRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
# Share of lines, and of line characters, that may repeat an earlier line.
LINE_LIMIT, LINE_CHARS_LIMIT = 0.30, 0.20
SYMBOLS = "#*$%&|<>"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BY_TEXT = np.uint64(0xD6E8FEB86659FD93)


def repeated(ids: np.ndarray, of: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each n-gram length, which words lie in an n-gram their text holds twice or more:
    in any occurrence, and in one that is not the first.

    ``ids`` are word numbers of texts laid end to end, ``of`` the text of each.
    One hash rolls from length to length. Windows with equal hashes are
    compared word by word, so a collision marks nothing.
    """
    top = max(lengths)
    values = ids.astype(np.uint64) + np.uint64(1)
    rolled = values * _BASE
    for n in range(2, top + 1):
        if len(ids) < n:
            if n in lengths:
                none = np.zeros(len(ids), dtype=bool)
                yield n, none, none
            continue
        rolled = (rolled[: len(ids) - n + 1] + values[n - 1 :]) * _BASE
        if n not in lengths:
            continue
        starts = np.flatnonzero(of[: len(ids) - n + 1] == of[n - 1 :])
        keys = rolled[starts] + of[starts].astype(np.uint64) * _BY_TEXT
        order = np.argsort(keys, kind="stable")
        keys, starts = keys[order], starts[order]
        pair = np.flatnonzero(keys[1:] == keys[:-1])
        a, b = starts[pair], starts[pair + 1]
        same = of[a] == of[b]
        for j in range(n):
            same &= ids[a + j] == ids[b + j]
        if not same.all():
            # A collision: put windows of one key in order of their words.
            a, b = _equal_neighbours(keys, starts, ids, of, n)
        else:
            a, b = a[same], b[same]
        yield n, _cover(np.union1d(a, b), n, len(ids)), _cover(b, n, len(ids))


def _cover(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside the windows of ``n`` words that begin at ``starts``, all different."""
    edges = np.zeros(words + 1, dtype=np.int32)
    edges[starts] += 1
    edges[starts + n] -= 1
    return np.cumsum(edges[:-1]) > 0


def _equal_neighbours(keys, starts, ids, of, n):
    grams = np.stack([keys.view(np.int64), of[starts], *[ids[starts + j] for j in range(n)]])
    order = np.lexsort(grams[::-1])
    grams, starts = grams[:, order], starts[order]
    pair = np.flatnonzero((grams[:, 1:] == grams[:, :-1]).all(axis=0))
    return starts[pair], starts[pair + 1]


def measure(texts: list[str], lengths: list[int]) -> dict[str, np.ndarray]:
    """Counts of each text; see ``repetition``."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    words = [t.encode().split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    chars = np.fromiter((len(w.decode()) for w in number), np.int64, len(number))[ids]
    of = np.repeat(np.arange(len(texts)), sizes)

    def per_text(weights: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights, minlength=len(texts)).astype(np.int64)

    out = {"n_words": sizes, "word_chars": per_text(chars)}
    out["n_symbols"] = np.array([sum(map(t.count, SYMBOLS)) for t in texts], dtype=np.int64)
    lines = np.array([_lines(t) for t in texts], dtype=np.int64).reshape(-1, 4)
    out |= dict(zip(("n_lines", "n_dup_lines", "line_chars", "dup_line_chars"), lines.T))
    for n, inside, again in repeated(ids, of, sorted({3, *lengths})):
        if n == 3:
            out["n_repeat_words"] = per_text(inside)
        if n in lengths:
            out[f"dup_chars_{n}"] = per_text(again * chars)
    return out


def _lines(text: str) -> tuple[int, int, int, int]:
    """Lines with a word, those equal to an earlier line, and the characters of both."""
    seen: set[str] = set()
    total = again = chars = chars_again = 0
    for line in text.split("\n"):
        if not line.strip(" \t\r\x0b\x0c"):
            continue
        total += 1
        chars += len(line)
        if line in seen:
            again += 1
            chars_again += len(line)
        seen.add(line)
    return total, again, chars, chars_again


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict."""

    gram_limits: dict[int, float] = field(default_factory=lambda: dict(GRAM_LIMITS))
    line_limit: float = LINE_LIMIT
    line_chars_limit: float = LINE_CHARS_LIMIT
    least_words: int = 50
    most_repeat: float = 0.5

    def counts(self) -> list[str]:
        return [
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "line_chars",
            "dup_line_chars", *[f"dup_chars_{n}" for n in sorted(self.gram_limits)],
        ]

    def judge(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Counts of each text, ``base_failed`` and ``kept``."""
        c = measure(texts, sorted(self.gram_limits))
        failed = (c["n_words"] < self.least_words) | (c["n_repeat_words"] > self.most_repeat * c["n_words"])
        over = c["n_dup_lines"] > self.line_limit * c["n_lines"]
        over |= c["dup_line_chars"] > self.line_chars_limit * c["line_chars"]
        for n, limit in self.gram_limits.items():
            over |= c[f"dup_chars_{n}"] > limit * c["word_chars"]
        return c | {"base_failed": failed, "kept": ~(failed | over)}


def repetition(df: DataFrame, text_col: str, id_col: str, rules: Rules = Rules()) -> DataFrame:
    """``id_col``, counts, ``base_failed`` and ``kept`` of every row.

    Words are runs of characters other than space and tab to carriage return;
    a line counts if it has a word. ``n_repeat_words`` are words inside 3-word
    windows found twice or more, first ones included, ``dup_chars_<n>`` the
    characters of words inside n-word windows that repeat an earlier one, so a
    word counts once however many windows hold it. ``base_failed``: fewer than
    ``least_words`` words, or over ``most_repeat`` of them repeated. ``kept``:
    not failed, and no share over its limit. Null and empty texts have zero
    counts and fail. Rows are judged one by one: ties, repeated rows and null
    ids come back as they are, and only the two named columns are read. Memory
    is bounded by the longest text.
    """
    counts = rules.counts()
    names = ["_id", *counts, "base_failed", "kept"]
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "_text"):
            found = rules.judge(part.column("_text").to_pylist())
            columns = [part.column("_id"), *[pa.array(found[c]) for c in names[1:]]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"_id {kind}, " + ", ".join(f"{c} long" for c in counts) + ", base_failed boolean, kept boolean"
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def keep_good(df: DataFrame, text_col: str, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``df`` that ``repetition`` keeps, with all their columns, in one pass."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, at):
            texts = [t or "" for t in part.column(at).to_pylist()]
            yield part.filter(pa.array(rules.judge(texts)["kept"]))

    return df.mapInArrow(run, df.schema)
