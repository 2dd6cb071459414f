"""Co-training: a text and a metadata classifier teach each other with confident labels.

Both views start from a bounded sample of labelled rows. In every round both
score all documents, and every document one view is sure of teaches the other
with the label it gives: the features of these documents are counted by label in
Spark, the counts give a weight for each feature, and the labelled rows decide
how much the sum of these weights says beside their own features. At the end
each view is calibrated on labelled rows it never trained on, and the calibrated
views are added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.workers import steps
from sluice.session import durable

# Labelled rows that are sampled at most for a target; a fifth of them calibrates, the rest trains.
LABELLED = 4000
ROUNDS = 2
# Parts in which counts are added up.
PARTS = 64
# A view hands over rows of which it gives a label at least this probability.
SURE = 0.95
TEXT_BITS, META_BITS = 18, 10
# Letters of a word's head, and features beside words.
HEAD, SHAPES = 5, 9
# Words count whose share differs between the classes by more than so many standard errors.
ERRORS = 3.5


def text_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of texts: damped counts of words and word heads of length one, and shares of
    kinds of characters."""
    width = 1 << TEXT_BITS
    # Empty pieces at the ends of a text are no words.
    cut = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.string()))
    met = cut.values.dictionary_encode()
    ids, pieces = met.indices.to_numpy(), np.diff(cut.offsets.to_numpy())
    is_word = pc.greater(pc.binary_length(met.dictionary), 0).to_numpy(zero_copy_only=False)[ids]
    of, ids = np.repeat(np.arange(len(texts)), pieces)[is_word], ids[is_word].astype(np.int64)
    plain, head = pc.utf8_trim(met.dictionary, characters=".,!?;:"), pc.utf8_slice_codeunits(met.dictionary, 0, HEAD)
    hashed = np.stack([_hashed(plain, 0), _hashed(head, 1)])[:, ids].ravel()
    cells, counts = np.unique(np.tile(of * width, 2) + hashed, return_counts=True)
    row, value = cells // width, np.log1p(counts)
    value /= np.sqrt(np.bincount(row, value**2, minlength=len(texts)))[row]
    own = np.sort(of * len(met.dictionary) + ids)
    first = np.diff(own, prepend=-1) > 0
    shape = _shapes(texts, *(np.bincount(x, minlength=len(texts)) for x in (of, of[first])))
    return (
        np.concatenate([row, np.repeat(np.arange(len(texts)), SHAPES)]),
        np.concatenate([cells % width, np.tile(width + np.arange(SHAPES), len(texts))]),
        np.concatenate([value, shape.ravel()]),
    )


def _hashed(values: pa.Array, seed: int) -> np.ndarray:
    """Features of strings, each different one hashed once."""
    met = values.dictionary_encode()
    return (hashes(met.dictionary, seed) % np.uint64(1 << TEXT_BITS)).astype(np.int64)[met.indices.to_numpy()]


def hashes(values: pa.Array, seed: int) -> np.ndarray:
    """XXH64 of strings, those of one length below 32 bytes at once."""
    one, two, three, four, five = np.array(
        [0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], dtype=np.uint64
    )

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint64(by)) | (x >> np.uint64(64 - by))

    out = np.zeros(len(values), dtype=np.uint64)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    starts = np.frombuffer(values.buffers()[1] or bytes(4), np.int32)[values.offset :][: len(values) + 1]
    starts, sizes = starts[:-1], np.diff(starts)
    for size in np.flatnonzero(np.bincount(sizes[sizes < 32])):
        at = np.flatnonzero(sizes == size)
        text = data[starts[at, None] + np.arange(size)]
        h, done = np.full(len(at), np.uint64(seed + size) + five), 0
        while done + 8 <= size:
            lane = turned(text[:, done : done + 8].copy().view("<u8")[:, 0] * two, 31) * one
            h, done = turned(h ^ lane, 27) * one + four, done + 8
        if done + 4 <= size:
            h, done = turned(h ^ text[:, done : done + 4].copy().view("<u4")[:, 0] * one, 23) * two + three, done + 4
        for byte in text.T[done:]:
            h = turned(h ^ byte * five, 11) * one
        h = (h ^ (h >> np.uint64(33))) * two
        h = (h ^ (h >> np.uint64(29))) * three
        out[at] = h ^ (h >> np.uint64(32))
    for at in np.flatnonzero(sizes >= 32):
        out[at] = xxhash.xxh64_intdigest(values[at].as_py(), seed)
    return out


def _shapes(texts: list[str], words: np.ndarray, different: np.ndarray) -> np.ndarray:
    """Shares of kinds of characters in texts of so many words and different words."""
    w = np.maximum(words, 1)
    kinds = ("#*$%&|<>{}[]@\\~^=_", "0123456789", ".,!?", ["http"])
    marks, digits, ends, links = (np.array([sum(map(t.count, k)) for t in texts], dtype=np.int64) for k in kinds)
    n = np.array([max(len(t), 1) for t in texts], dtype=np.int64)
    lines = [t.split("\n") for t in texts]
    lines = np.array([len(set(x)) / len(x) for x in lines])
    return np.stack([
        np.ones(len(texts)), np.log1p(words) / 5, different / w, n / w / 10, marks / n * 10,
        digits / n * 5, ends / w, lines, links / w * 10,
    ], axis=1)


def meta_features(values: list[list[str]], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of metadata: each value by its column, and the size of the number columns."""
    width = 1 << META_BITS
    rows, features = [], []
    for at, column in enumerate(values):
        hashed = {v: xxhash.xxh64_intdigest(f"{at}={v}") % (width - 1) for v in set(column)}
        rows.append(np.arange(len(column)))
        features.append(np.fromiter(map(hashed.__getitem__, column), np.int64, len(column)))
    for at, column in enumerate(numbers):
        level = np.floor(2 * np.log2(1 + np.maximum(np.nan_to_num(column), 0))).astype(np.int64)
        rows.append(np.arange(len(column)))
        features.append(np.array([xxhash.xxh64_intdigest(f"#{at}={v}") % (width - 1) for v in level], dtype=np.int64))
    count = len(rows[0]) if rows else 0
    rows.append(np.arange(count))
    features.append(np.full(count, width - 1))
    row = np.concatenate(rows)
    return row, np.concatenate(features).astype(np.int64), np.ones(len(row))


def logit(weights: np.ndarray, features: tuple, rows: int) -> np.ndarray:
    row, feature, value = features
    return np.bincount(row, value * weights[feature], minlength=rows)


def telling(features: tuple, label: np.ndarray, width: int) -> np.ndarray:
    """Features held by clearly different shares of the two classes, three rows at least; and those every row has."""
    row, feature, value = features
    held = feature[value != 0]
    count = np.bincount(held, minlength=width)
    with_label = np.bincount(held, label[row[value != 0]], minlength=width)
    return apart(count, with_label, label.sum(), len(label))


def apart(count: np.ndarray, with_label: np.ndarray, ones: float, rows: int) -> np.ndarray:
    """``telling`` from the rows that hold each feature, all and those of the label."""
    share = count / max(rows, 1)
    error = np.sqrt(share * (1 - share) * (1 / max(ones, 1) + 1 / max(rows - ones, 1)))
    gap = np.abs(with_label / max(ones, 1) - (count - with_label) / max(rows - ones, 1))
    return ((gap > ERRORS * error) & (count >= 3)) | (share > 0.5)


def counted(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Weights from the rows of either label that hold each feature: log-odds of telling ones, none without rows of both."""
    if not rows.all():
        return np.zeros(counts.shape[1])
    shares = np.log((counts + 1) / (rows[:, None] + 2))
    return np.where(apart(counts.sum(axis=0), counts[1], rows[1], rows.sum()), shares[1] - shares[0], 0.0)


def taught(features: tuple, label: np.ndarray, lesson: np.ndarray) -> np.ndarray:
    """Weights of a view: ``train`` on labelled rows, to which ``lesson``, weights learnt from other rows, is one more feature."""
    rows, width = len(label), len(lesson)
    told = logit(lesson, features, rows)
    spread = told.std() if rows else 0.0
    if not spread:
        return train(features, label, rows, width)
    more = np.arange(rows), np.full(rows, width), (told - told.mean()) / spread
    weights = train(tuple(np.concatenate([a, b]) for a, b in zip(features, more)), label, rows, width + 1)
    return (weights[:width] + weights[width] / spread * lesson).astype(np.float32)


def train(features: tuple, label: np.ndarray, rows: int, width: int, rounds: int = 200, damp: float = 1e-4) -> np.ndarray:
    """Logistic regression on telling features, classes of equal weight, by gradient steps of adapted size."""
    keep = telling(features, label, width)[features[1]]
    row, feature, value = (x[keep] for x in features)
    features = row, feature, value
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3) if rows else 0.5
    cost = np.where(label > 0, 0.5 / share, 0.5 / (1 - share)) / max(rows, 1)
    weights, square = np.zeros(width), np.full(width, 1e-8)
    for _ in range(rounds):
        odds = np.clip(logit(weights, features, rows), -30, 30)
        wrong = (1 / (1 + np.exp(-odds)) - label) * cost
        gradient = np.bincount(feature, value * wrong[row], minlength=width) + damp * weights
        square += gradient**2
        weights -= 0.3 * gradient / np.sqrt(square)
    return weights.astype(np.float32)


def calibrate(scores: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn a view's score into the log-odds of the label; slope 0 where it says nothing."""
    scale = (scores.std() if len(scores) else 0.0) or 1.0
    x, a, b = scores / scale, 0.0, 0.0
    # Two rows of each class in advance keep the odds finite.
    x = np.append(x, [0, 0, 0, 0])
    label = np.append(label, [0, 1, 0, 1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = p * (1 - p) + 1e-6
        g = np.array([((p - label) * x).sum() + 1e-3 * a, (p - label).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 0.0) / scale, b


@dataclass
class Columns:
    """The columns of a table that the two views see."""

    text: str
    id: str
    names: list[str]
    numbers: list[str]

    def select(self, df: DataFrame) -> DataFrame:
        return df.select(
            F.col(self.id).alias("_id"), F.coalesce(F.col(self.text), F.lit("")).alias("_text"),
            *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_v{i}") for i, c in enumerate(self.names)],
            *[F.col(c).cast("double").alias(f"_n{i}") for i, c in enumerate(self.numbers)],
        )

    def features(self, part: pa.RecordBatch) -> tuple[tuple, tuple]:
        values = [part.column(f"_v{i}").to_pylist() for i in range(len(self.names))]
        numbers = [part.column(f"_n{i}").to_numpy(zero_copy_only=False) for i in range(len(self.numbers))]
        if not values and not numbers:
            values = [[""] * part.num_rows]
        return text_features(part.column("_text").to_pylist()), meta_features(values, numbers)


def gathered(rows: DataFrame, columns: Columns, extra: list[str]) -> tuple[pd.DataFrame, list[tuple]]:
    """Features of a bounded number of rows on the driver, both views, with their ``extra`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "_text"):
            views = columns.features(part)
            out = [part.column(c) for c in extra]
            for row, feature, value in views:
                order = np.argsort(row, kind="stable")
                offsets = pa.array(np.searchsorted(row[order], np.arange(part.num_rows + 1)).astype(np.int32))
                out += [
                    pa.ListArray.from_arrays(offsets, pa.array(feature[order].astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(value[order].astype(np.float32))),
                ]
            yield pa.RecordBatch.from_arrays(out, names=[*extra, "f0", "x0", "f1", "x1"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in extra)
    lists = "f0 array<int>, x0 array<float>, f1 array<int>, x1 array<float>"
    found = rows.mapInArrow(run, f"{kinds}, {lists}").toPandas()
    views = []
    for view in "01":
        sizes = [len(f) for f in found[f"f{view}"]]
        row = np.repeat(np.arange(len(found), dtype=np.int32), sizes)
        kinds = ((f"f{view}", np.int32), (f"x{view}", np.float32))
        views.append((row, *[np.concatenate([np.zeros(0, kind), *found[c]]).astype(kind, copy=False) for c, kind in kinds]))
    return found[extra].copy(), views


def _some(features: tuple, keep: np.ndarray) -> tuple:
    """The features of some rows, renumbered."""
    row, feature, value = features
    place = np.cumsum(keep, dtype=np.int32) - 1
    inside = keep[row]
    return place[row[inside]], feature[inside], value[inside]


def scored(rows: DataFrame, columns: Columns, weights: dict[tuple[str, int], np.ndarray], kind: str) -> DataFrame:
    """Scores of every row by each target and view: columns ``<target>_<view>``."""
    names = [f"{t}_{v}" for t, v in weights]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "_text"):
            views = columns.features(part)
            found = [pa.array(logit(w, views[v], part.num_rows)) for (_, v), w in weights.items()]
            yield pa.RecordBatch.from_arrays([part.column("_id"), *found], names=["_id", *names])

    return rows.mapInArrow(run, f"_id {kind}, " + ", ".join(f"{n} double" for n in names))


def lessons(
    rows: DataFrame, columns: Columns, weights: dict[tuple[str, int], np.ndarray], lines: dict[tuple[str, int], tuple[float, float]]
) -> dict[tuple[str, int], np.ndarray]:
    """What each view is taught: weights from the features, by label, of every row that the other view is sure of.

    Tasks count, and counts are added up in parts inside tasks, so the driver gets
    numbers of a fixed size, however many rows there are.
    """
    sure = float(np.log(SURE / (1 - SURE)))
    # For each target and view, two rows of counts by label; the last column counts the rows themselves.
    shapes = {k: (2, len(w) + 1) for k, w in weights.items()}
    ends = np.cumsum([0, *[int(np.prod(s)) for s in shapes.values()]])

    def split(values: np.ndarray) -> dict[tuple[str, int], np.ndarray]:
        return {k: values[a:b].reshape(s) for (k, s), a, b in zip(shapes.items(), ends, ends[1:])}

    def out(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        values = [v.tobytes() for v in parts.values()]
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(values, pa.binary())], names=["at", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ends[-1], dtype=np.int64)
        counts = split(total)
        for part in steps(batches, "_text"):
            views = columns.features(part)
            for (t, v), found in counts.items():
                slope, offset = lines[t, 1 - v]
                odds = logit(weights[t, 1 - v], views[1 - v], part.num_rows) * slope + offset
                row, feature, value = views[v]
                for label, chosen in enumerate((odds <= -sure, odds >= sure)):
                    found[label, :-1] += np.bincount(feature[chosen[row] & (value != 0)], minlength=found.shape[1] - 1)
                    found[label, -1] += chosen.sum()
        yield out(dict(enumerate(np.array_split(total, PARTS))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(*(c.to_pylist() for c in batch.columns)):
                sums[at] = sums.get(at, 0) + np.frombuffer(counts, np.int64)
        yield out(sums)

    kind = "at int, counts binary"
    parts = np.array_split(np.zeros(ends[-1], dtype=np.int64), PARTS)
    for at, counts in rows.mapInArrow(run, kind).repartition("at").mapInArrow(add, kind).collect():
        parts[at] = np.frombuffer(counts, np.int64)
    return {k: counted(c[:, :-1], c[:, -1]) for k, c in split(np.concatenate(parts)).items()}


def cotrain(
    df: DataFrame,
    labels: DataFrame,
    columns: Columns,
    targets: list[str],
    *,
    labelled: int = LABELLED,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``id`` and, per target, ``<target>_score``, ``<target>_text`` and ``<target>_meta`` of every row.

    ``labels`` has the id and 0/1 ``targets``, null where a row has no label for
    one. For each target at most ``labelled`` of its ids, picked by a hash, are
    used: four fifths train, one fifth calibrates. Every round scores all other
    rows with both views; all those to which a view gives a label with a
    calibrated probability of at least ``SURE`` teach the other view (rows without
    id are scored, but teach nothing). The
    views are probabilities by one view alone, the score combines both. Null
    texts are empty, null metadata is a value of its own; an id that labels
    give twice counts once, with the larger value. Where labels are missing
    or of one class, scores are near the share of that class. Repeated rows get equal scores;
    an empty table gives no rows. Columns not named are not read.
    """
    kind = df.schema[columns.id].dataType.simpleString()
    rows = columns.select(df)
    known = labels.filter(F.col(columns.id).isNotNull()).groupBy(F.col(columns.id).alias("_id")).agg(
        *[F.max(t).cast("int").alias(t) for t in targets]
    )
    sample = None
    for t in targets:
        some = known.filter(F.col(t).isNotNull()).orderBy(F.xxhash64("_id"), "_id").limit(labelled)
        sample = some if sample is None else sample.union(some)
    # At most ``labelled`` rows for each target, so they can be sent to every task.
    sample = durable(sample.distinct())
    found, views = gathered(rows.join(F.broadcast(sample), "_id"), columns, ["_id", *targets])
    held = np.array([xxhash.xxh64_intdigest(str(i)) % 5 == 0 for i in found["_id"]], dtype=bool)
    width = [(1 << TEXT_BITS) + SHAPES, 1 << META_BITS]
    labels_of = {t: found[t].to_numpy(float) for t in targets}
    known_to = {t: ~np.isnan(label) for t, label in labels_of.items()}
    lesson = {(t, v): np.zeros(width[v]) for t in targets for v in (0, 1)}

    def fitted() -> tuple[dict[tuple[str, int], np.ndarray], dict[tuple[str, int], tuple[float, float]]]:
        weights, lines = {}, {}
        for (t, v), told in lesson.items():
            trains, calibrates = known_to[t] & ~held, known_to[t] & held
            w = weights[t, v] = taught(_some(views[v], trains), labels_of[t][trains], told)
            label = labels_of[t][calibrates]
            lines[t, v] = calibrate(logit(w, _some(views[v], calibrates), len(label)), label)
        return weights, lines

    others = rows.filter(F.col("_id").isNotNull()).join(F.broadcast(sample.select("_id")), "_id", "left_anti")
    for _ in range(rounds):
        lesson = lessons(others, columns, *fitted())
    weights, lines = fitted()
    out = scored(rows, columns, weights, kind)
    for t in targets:
        label = labels_of[t][known_to[t] & held]
        prior = np.log((label.sum() + 1) / (len(label) - label.sum() + 1))
        odds: list[Column] = [F.col(f"{t}_{v}") * lines[t, v][0] + lines[t, v][1] for v in (0, 1)]
        for name, odd in (("text", odds[0]), ("meta", odds[1]), ("score", odds[0] + odds[1] - float(prior))):
            out = out.withColumn(f"{t}_{name}", 1 / (1 + F.exp(-odd)))
    return out.select(F.col("_id").alias(columns.id), *[f"{t}_{n}" for t in targets for n in ("score", "text", "meta")])
