"""Periodic stretches of words, seeded by block convolution.

At each dyadic scale ``s`` the text is cut at multiples of ``s``. The block at
a cut is compared with every place of the window ``s`` to ``2 s`` words further
on: the sums of squared differences come from a convolution by number
theoretic transforms, exact in whole numbers, and a sum of zero is an
occurrence. Its distance is a candidate period, and the stretch around it with
that period is found by extending to both sides. A run at least three periods
long holds a cut block and its next occurrence at one of the scales.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.workers import steps

# A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
# The transform's prime, 2^16 + 1, with 3 as a primitive root.
PRIME, ROOT = 65537, 3
# Words of the longest block compared; longer scales compare the head of each block.
BLOCK = 32
# Words are compared as numbers below LEVELS, so that a sum of squares stays below the prime.
LEVELS = 46
# Blocks convolved at once.
SLICE = 8192

_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _matrix(points: int, inverse: bool) -> np.ndarray:
    root = pow(ROOT, (PRIME - 1) // points, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    powers = np.ones(points, dtype=np.int64)
    for i in range(1, points):
        powers[i] = powers[i - 1] * root % PRIME
    at = np.arange(points)
    found = powers[at[:, None] * at[None, :] % points]
    if inverse:
        found = found * pow(points, -1, PRIME) % PRIME
    return found.astype(np.float64)


def _mod(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime; whole numbers below 2^52 held in doubles, changed in place."""
    x -= np.floor(x * (1.0 / PRIME)) * PRIME
    x[x < 0] += PRIME
    x[x >= PRIME] -= PRIME
    return x


class Convolver:
    """Blocks of ``size`` words of one text against windows of twice that size.

    Windows are pairs of neighbouring blocks, so the transform of each block is
    worked out once and serves as pattern and as part of windows. A product
    with the transform's matrix has sums below 2^39, exact in doubles.
    """

    def __init__(self, values: np.ndarray, size: int):
        self.size, points = size, 2 * size
        rows = -(-len(values) // size)
        blocks = np.zeros((rows + 2, size))
        blocks.ravel()[: len(values)] = values
        self.ahead = _mod(blocks @ _matrix(points, False)[:size])
        self.back = _matrix(points, True)[:, :size]
        self.sign = 1.0 - 2.0 * (np.arange(points) % 2)
        self.mirror = -np.arange(points) % points
        squares = np.concatenate([[0], np.cumsum(blocks.ravel() ** 2)])
        self.rows, self.squares = rows, squares

    def matches(self, patterns: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of a pattern block and of a place in the window at ``windows`` (block numbers) that equals it."""
        size, found = self.size, ([], [])
        offsets = np.arange(size)
        for at in range(0, len(patterns), SLICE):
            a, c = patterns[at : at + SLICE], windows[at : at + SLICE]
            window = self.ahead[c] + self.sign * self.ahead[c + 1]
            product = _mod(self.ahead[a][:, self.mirror] * window)
            crossed = product @ self.back
            starts = c[:, None] * size + offsets
            own = self.squares[(a + 1) * size] - self.squares[a * size]
            differences = own[:, None] + (self.squares[starts + size] - self.squares[starts]) - 2 * crossed
            i, o = np.nonzero(_mod(differences) == 0)
            found[0].append(a[i] * size)
            found[1].append(c[i] * size + o)
        return np.concatenate(found[0]), np.concatenate(found[1])


def _seeds(values: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and distances of matching blocks, scale by scale, for periods up to ``longest``."""
    made: dict[int, Convolver] = {}
    scale = 8
    while scale <= max(longest, 8):
        size = min(scale, BLOCK)
        conv = made.get(size) or made.setdefault(size, Convolver(values, size))
        step = scale // size
        windows = np.arange(step, conv.rows)
        patterns = (windows // step - 1) * step
        if scale == 8:
            # Periods below the scale: the window that begins with the block itself.
            windows = np.concatenate([np.arange(conv.rows), windows])
            patterns = np.concatenate([np.arange(conv.rows), patterns])
        if len(windows):
            x, y = conv.matches(patterns, windows)
            moved = y > x
            yield x[moved], (y - x)[moved]
        scale *= 2


class Text:
    """Words of several texts laid end to end, each followed by a word that nothing equals."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        ends = np.cumsum(sizes)
        self.ids = np.insert(ids.astype(np.int64), ends, -1 - np.arange(len(sizes)))
        self.starts = ends - sizes + np.arange(len(sizes))
        self.of = np.repeat(np.arange(len(sizes)), sizes + 1)
        self.sizes = sizes
        mixed = (self.ids.view(np.uint64) + np.uint64(1)) * _MIX
        self.levels = ((mixed >> np.uint64(40)) % np.uint64(LEVELS)).astype(np.float64)
        self.powers = np.cumprod(np.full(len(mixed) + 1, _BASE))
        self.prefix = np.concatenate([[np.uint64(0)], np.cumsum((mixed ^ (mixed >> np.uint64(29))) * self.powers[:-1])])

    def _alike(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Are the hashes of ``length`` words at ``a`` and further on at ``b`` equal?"""
        one, two = self.prefix[a + length] - self.prefix[a], self.prefix[b + length] - self.prefix[b]
        return one * self.powers[b - a] == two * self.powers[0]

    def extend(self, x: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the stretch with period ``d`` around a match at ``x``, by bisection on hashes.

        Equal words have equal hashes, so a stretch never comes out too short.
        """
        of = self.of[x]
        low, high = np.zeros_like(x), self.starts[of] + self.sizes[of] - (x + d)
        low_back, high_back = np.zeros_like(x), x - self.starts[of]
        for _ in range(int(max(high.max(), high_back.max(), 1)).bit_length()):
            middle = (low + high + 1) // 2
            fits = self._alike(x, x + d, middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
            middle = (low_back + high_back + 1) // 2
            fits = self._alike(x - middle, x - middle + d, middle)
            low_back, high_back = np.where(fits, middle, low_back), np.where(fits, high_back, middle - 1)
        return x - low_back, x + d + low

    def extend_by_words(self, x: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``extend``, word by word: for when hashes have misled."""
        ids, starts, ends = self.ids, [], []
        for at, step in zip(x.tolist(), d.tolist()):
            low = high = at
            first, last = self.starts[self.of[at]], self.starts[self.of[at]] + self.sizes[self.of[at]]
            while high + step < last and ids[high] == ids[high + step]:
                high += 1
            while low > first and ids[low - 1] == ids[low - 1 + step]:
                low -= 1
            starts.append(low)
            ends.append(high + step)
        return np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)

    def periodic(self, start: int, end: int, d: int) -> bool:
        return bool((self.ids[start : end - d] == self.ids[start + d : end]).all())


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of texts laid end to end, in that order.

    A run has its smallest period and reaches as far as it can. Blocks meet by
    small numbers and stretches by hashes; every run is compared word by word
    before it counts, and a disagreement has its scale worked out by words.
    """
    if not len(sizes) or not len(ids):
        return np.zeros((0, 4), dtype=np.int64)
    text = Text(ids, sizes)
    known: dict[tuple[int, int], int] = {}
    for x, d in _seeds(text.levels, int(sizes.max()) // LEAST_PERIODS):
        inside = x + d < len(text.ids)
        x, d = x[inside], d[inside]
        same = (text.of[x] == text.of[x + d]) & (text.ids[x] == text.ids[x + d])
        x, d = _open(x[same], d[same], known)
        if not len(x):
            continue
        if not _settle(text, known, *text.extend(x, d), d):
            _settle(text, known, *text.extend_by_words(x, d), d)
    if not known:
        return np.zeros((0, 4), dtype=np.int64)
    spans = np.array([(s, e, q) for (s, e), q in known.items()], dtype=np.int64)
    of = text.of[spans[:, 0]]
    out = np.stack([of, spans[:, 0] - text.starts[of], spans[:, 1] - spans[:, 0], spans[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _open(x: np.ndarray, d: np.ndarray, known: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
    """Without the matches inside a known run whose period divides their distance: they give that run again."""
    if not known or not len(x):
        return x, d
    spans = np.array(sorted((s, e, q) for (s, e), q in known.items()), dtype=np.int64)
    reach = np.maximum.accumulate(spans[:, 1])
    widest = np.maximum.accumulate(np.where(spans[:, 1] == reach, np.arange(len(spans)), 0))
    at = np.searchsorted(spans[:, 0], x, side="right") - 1
    run = spans[widest[np.maximum(at, 0)]]
    again = (at >= 0) & (x + 2 * d <= run[:, 1]) & (d % run[:, 2] == 0)
    return x[~again], d[~again]


def _settle(text: Text, known: dict[tuple[int, int], int], start: np.ndarray, end: np.ndarray, d: np.ndarray) -> bool:
    """Put stretches that are long enough into ``known`` with their smallest period; False if one is none."""
    long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * d)
    found = np.unique(np.stack([start[long], end[long], d[long]], axis=1), axis=0)
    new = dict(known)
    for s, e, q in found.tolist():
        have = new.get((s, e))
        if have is not None and q % have == 0:
            continue
        if not text.periodic(s, e, q):
            return False
        new[s, e] = min(q, have or q)
    known.update(new)
    return True


def runs_of(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[str]]:
    """Word counts, runs (start, length, period as rows) and collapsed texts.

    Texts of like length are worked on together, so that short ones are not
    searched for the periods of long ones.
    """
    number: dict[bytes, int] = defaultdict(count().__next__)
    words = [t.encode().split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    found = [np.zeros((0, 3), dtype=np.int64)] * len(texts)
    long = np.flatnonzero(sizes >= LEAST_WORDS)
    classes = np.frexp(sizes[long].astype(np.float64))[1]
    for kind in np.unique(classes):
        rows = long[classes == kind]
        own = sizes[rows]
        ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words[r] for r in rows)), np.int64, int(own.sum()))
        hits = find_runs(ids, own)
        for i in np.unique(hits[:, 0]):
            found[rows[i]] = hits[hits[:, 0] == i, 1:]
    return sizes, found, [_collapsed(w, r) for w, r in zip(words, found)]


def _collapsed(words: list[bytes], runs: np.ndarray) -> str:
    if len(runs):
        edges = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
        words = compress(words, (np.cumsum(edges[:-1]) == 0).tolist())
    return b" ".join(words).decode()


def periodic_runs(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``id_col``, ``n_words``, ``runs`` and ``collapsed`` of every row.

    Words are runs of characters other than space and tab to carriage return.
    ``runs`` is an array of (start, length, period) in words, by start and then
    period: stretches of at least 24 words and three times their smallest
    period that no neighbouring word extends. ``collapsed`` is the text without
    the words that a run holds after its first period, joined by one space.
    Null, empty and short texts have no runs. Rows are independent: ties,
    repeated rows and null ids come back as they are. An empty table gives no
    rows; further columns are not read. Memory is bounded by the longest text.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    names = ["_id", "n_words", "runs", "collapsed"]
    parts = ["start", "length", "period"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "_text"):
            sizes, found, collapsed = runs_of(part.column("_text").to_pylist())
            flat = np.concatenate(found)
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)], names=parts)
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), spans), pa.array(collapsed, pa.string())],
                names=names,
            )

    schema = f"_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
