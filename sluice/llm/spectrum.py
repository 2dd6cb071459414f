"""Embedding whitening by an incremental eigendecomposition.

Every partition keeps the eigenvalues and eigenvectors of the scatter of the
vectors it has seen and takes in each further one as a centred rank-one
update: the secular equation gives the new eigenvalues, directions that the
update does not touch are deflated. Spectra of partitions are combined by
rank-one updates too, in a tree. A last pass over all rows projects the
covariance on the combined vectors and solves that small problem exactly
(Rayleigh-Ritz), so rounding in the updates leaves no trace.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import durable

_EPS = np.finfo(np.float64).eps
# Spectra combined by one task of the tree.
FAN_IN = 16
# Eigenvalues below this share of the largest count as zero: nothing can be whitened along them.
NOTHING = 1e-13


def secular_roots(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Roots of ``1 + sum(w / (d - x))`` less ``d``, as a matrix ``d[j] - root[i]``.

    ``d`` ascends without ties and ``w`` is positive, so each root lies
    between two poles, the last beyond them. Each is sought from the nearer
    pole, which keeps small differences exact.
    """
    k = len(d)
    right = np.append(d[1:], d[-1] + w.sum())
    middle = (d + right) / 2
    value = 1 + (w / (d[None, :] - middle[:, None])).sum(axis=1)
    near_left = value >= 0
    near_left[-1] = True
    last = np.minimum(np.arange(k) + 1, k - 1)
    at = np.where(near_left, np.arange(k), last)
    gaps = d[None, :] - d[at][:, None]
    width = right - d
    low = np.where(near_left, 0.0, -width / 2)
    high = np.where(near_left, np.where(np.arange(k) == k - 1, width, width / 2), 0.0)
    mu = (low + high) / 2
    left = np.tri(k, dtype=bool)
    one, two = gaps.diagonal(), gaps[np.arange(k), last]
    two[-1] = 2 * width[-1]
    for _ in range(100):
        away = gaps - mu[:, None]
        terms = w / away
        slopes = terms / away
        f = 1 + terms.sum(axis=1)
        # Rounding of this size is undone by the last pass; a settled root stays where it is.
        open_ = np.abs(f) > 1e-13 * (1 + np.abs(terms).sum(axis=1))
        if not open_.any():
            break
        low, high = np.where(f < 0, mu, low), np.where(f < 0, high, mu)
        # A rational model of both sides, with the poles next to the root kept.
        a1, a2 = one - mu, two - mu
        psi = (slopes * left).sum(axis=1)
        phi = slopes.sum(axis=1) - psi
        a = (a1 + a2) * f - a1 * a2 * (psi + phi)
        b = a1 * a2 * f
        c = f - a1 * psi - a2 * phi
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = mu + step
        inside = np.isfinite(new) & (new >= low) & (new <= high) & (new != 0)
        mu = np.where(open_, np.where(inside, new, (low + high) / 2), mu)
    return gaps - mu[:, None]


@dataclass
class Spectrum:
    """Count, exact sums, and the scatter about the mean as eigenvalues (ascending) and vectors (columns)."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width, dtype=np.int64), np.zeros(width), np.eye(width))

    def add(self, x: np.ndarray) -> None:
        """Take in one integer vector: a rank-one update by its difference from the mean so far."""
        if self.n:
            away = (self.n * x - self.sums) / self.n
            self.update(away * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.sums = self.sums + x

    def merge(self, other: Spectrum) -> Spectrum:
        """Take in another spectrum: one update for each of its directions, one for the means' difference."""
        if self.n and other.n:
            away = (other.sums * self.n - self.sums * other.n) / (self.n * other.n)
            self.update(away * np.sqrt(self.n * other.n / (self.n + other.n)))
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(np.sqrt(value) * vector)
        self.n, self.sums = self.n + other.n, self.sums + other.sums
        return self

    def update(self, v: np.ndarray) -> None:
        """Add ``v v'`` to the scatter."""
        d, z = self.values, self.vectors.T @ v
        norm = np.sqrt(z @ z)
        if norm == 0:
            return
        scale = max(d[-1], norm * norm)
        tiny = 8 * _EPS * scale
        # Equal eigenvalues: turn their vectors until one of them alone meets the update.
        cuts = np.flatnonzero(np.diff(d) > tiny) + 1
        if len(cuts) + 1 < len(d):
            for start, end in zip([0, *cuts], [*cuts, len(d)]):
                if end - start > 1:
                    self._gather(slice(start, end), z)
        moved = np.flatnonzero(np.abs(z) * norm > tiny)
        if not len(moved):
            return
        d_in, z_in = d[moved], z[moved]
        away = secular_roots(d_in, z_in * z_in)
        # The update for which these roots are exact (Gu and Eisenstat): its vectors are orthogonal.
        k = len(moved)
        poles = d_in[:, None] - d_in[None, :]
        np.fill_diagonal(poles, 1.0)
        ratio = -away / poles.T
        ratio[np.arange(k), np.arange(k)] = -away.diagonal()
        exact = np.sqrt(np.abs(np.prod(ratio, axis=0))) * np.sign(z_in)
        turn = exact[None, :] / away
        turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
        new_values = d.copy()
        new_values[moved] = d_in - away.diagonal()
        vectors = self.vectors.copy()
        vectors[:, moved] = self.vectors[:, moved] @ turn.T
        order = np.argsort(new_values, kind="stable")
        self.values, self.vectors = new_values[order], vectors[:, order]

    def _gather(self, part: slice, z: np.ndarray) -> None:
        """A reflection of equal eigenvalues' vectors that leaves ``z`` one entry among them."""
        own = z[part].copy()
        norm = np.sqrt(own @ own)
        if norm == 0:
            return
        mirror = own.copy()
        mirror[-1] += np.copysign(norm, own[-1])
        mirror /= np.sqrt(mirror @ mirror)
        vectors = self.vectors[:, part]
        self.vectors = self.vectors.copy()
        self.vectors[:, part] = vectors - 2 * np.outer(vectors @ mirror, mirror)
        z[part] = 0
        z[part.stop - 1] = -np.copysign(norm, own[-1])


# ---- Spark

_SPECTRUM = "node long, n long, sums array<long>, eigenvalues array<double>, vectors array<double>"
_SUMS = "node long, n long, sums array<double>"


def integers(vector: Column) -> Column:
    """Entries as whole numbers: ``floor(1024 * entry) + 100000``."""
    return F.transform(vector, lambda c: F.floor(F.lit(1024.0) * c.cast("double")).cast("long") + F.lit(100000))


def fit_list(df: DataFrame, vector_col: str, id_col: str) -> DataFrame:
    """``_id`` and ``_x`` (whole numbers) of the rows that count.

    Rows whose vector is null, empty or holds a null, NaN or infinite entry are
    dropped; of vectors of several lengths the commonest length stays (the
    longest of those that are equally common).
    """
    good = F.forall(
        vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    ) & (F.size(vector_col) > 0)
    rows = df.filter(good).select(F.col(id_col).alias("_id"), integers(F.col(vector_col)).alias("_x"))
    sizes = rows.groupBy(F.size("_x").alias("_size")).count().orderBy(F.desc("count"), F.desc("_size")).head(1)
    return rows.filter(F.size("_x") == (sizes[0]["_size"] if sizes else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def tree(rows: DataFrame, schema: str, combine: Callable[[pa.Table], dict]) -> DataFrame:
    """One row from a table of partial results (column ``node``: which partition), combined ``FAN_IN`` at a time.

    The number of rounds is the logarithm of the number of rows; a task holds
    ``FAN_IN`` rows, and the driver none.
    """
    rows = durable(rows)
    while rows.count() > 1:
        ranked = rows.withColumn("node", F.floor(F.col("node") / FAN_IN))

        def run(table: pa.Table) -> pa.Table:
            out = combine(table) | {"node": [table.column("node")[0].as_py()]}
            return pa.table({name: out[name] for name in table.column_names})

        rows = durable(ranked.groupBy("node").applyInArrow(run, schema))
    return rows


def spectra(rows: DataFrame) -> DataFrame:
    """The spectrum of each partition of ``rows`` (column ``_x``)."""
    numbered = rows.select("_x", F.spark_partition_id().cast("long").alias("node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, node = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node")[0].as_py()
            for x in matrix(batch.column("_x")):
                own = own or Spectrum.empty(len(x))
                own.add(x)
        if own is not None:
            yield _row(own, node)

    return numbered.mapInArrow(run, _SPECTRUM)


def _row(s: Spectrum, node: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "node": [node], "n": [s.n], "sums": [s.sums], "eigenvalues": [s.values], "vectors": [s.vectors.ravel()],
    }, schema=pa.schema([
        ("node", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())),
        ("eigenvalues", pa.list_(pa.float64())), ("vectors", pa.list_(pa.float64())),
    ]))


def _spectrum(row) -> Spectrum:
    return Spectrum(
        row["n"], np.array(row["sums"], dtype=np.int64), np.array(row["eigenvalues"]),
        np.array(row["vectors"]).reshape(len(row["sums"]), -1),
    )


def _combined(table: pa.Table) -> dict:
    whole = reduce(Spectrum.merge, map(_spectrum, sorted(table.to_pylist(), key=lambda r: -r["n"])))
    return {"n": [whole.n], "sums": [whole.sums], "eigenvalues": [whole.values], "vectors": [whole.vectors.ravel()]}


def _added(table: pa.Table) -> dict:
    return {"n": [sum(table.column("n").to_pylist())], "sums": [matrix(table.column("sums").combine_chunks()).sum(axis=0)]}


def second_moments(rows: DataFrame, n: int, sums: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Mean of the centred rows and of their products with each other, both after multiplication with ``by``."""
    width = by.shape[1]
    numbered = rows.select("_x", F.spark_partition_id().cast("long").alias("node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, node = np.zeros(width * width + width), 0, 0
        for batch in batches:
            if batch.num_rows:
                node = batch.column("node")[0].as_py()
                y = centred(matrix(batch.column("_x")), n, sums) @ by
                total += np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])
                seen += batch.num_rows
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([node]), pa.array([seen]), pa.array([total], pa.list_(pa.float64()))], names=["node", "n", "sums"]
            )

    found = np.array(tree(numbered.mapInArrow(run, _SUMS), _SUMS, _added).head()["sums"]) / n
    mean = found[width * width :]
    return found[: width * width].reshape(width, width) - np.outer(mean, mean)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - sums / n``, the difference taken in whole numbers."""
    whole, rest = np.divmod(sums, n)
    return (x - whole) - rest / n


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found: count, exact sums, components as columns (largest eigenvalue first), eigenvalues, trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def fit(rows: DataFrame, components: int = 8) -> Whitening | None:
    """Leading components of the covariance of ``rows`` (column ``_x``); None without a row.

    Components along which the rows do not vary are left out. Everything the
    driver sees has the size of the covariance.
    """
    whole = tree(spectra(rows), _SPECTRUM, _combined).head()
    if whole is None:
        return None
    found = _spectrum(whole)
    basis = np.linalg.qr(found.vectors[:, ::-1])[0]
    ritz = second_moments(rows, found.n, found.sums, basis)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    count = min(components, int((values > NOTHING * max(values[0], 0)).sum()))
    trace = float(np.trace(ritz))
    top = basis @ turn[:, :count]
    error = 0.0
    if count:
        white = second_moments(rows, found.n, found.sums, top / np.sqrt(values[:count]))
        error = float(np.abs(white - np.eye(count)).max())
    return Whitening(found.n, found.sums, top, values[:count], trace, error)


def whiten(df: DataFrame, vector_col: str, id_col: str, components: int = 8) -> DataFrame:
    """Whitened coordinates of every row with a usable vector, a row for each component.

    Columns: ``id_col``, ``component`` (from 1, largest eigenvalue first), ``n``
    (rows fitted), ``deviation`` (sum over dimensions of ``(n * x - S)^2``,
    exact), ``whitened``, ``explained`` (the component's share of the variance)
    and ``identity_error`` (largest entry of the whitened rows' covariance less
    the identity). Entries enter as whole numbers (``integers``). Rows with a
    null vector or a null or non-finite entry are dropped, see ``fit_list``.
    Null ids, ties and repeated rows count and come back like any other.
    Directions without variance give no component, so a table whose vectors are
    all equal, or an empty one, gives no rows. Further columns are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = fit_list(df, vector_col, id_col)
    schema = f"_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(rows, components)
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("_id", id_col)
    n, sums, count = model.n, model.sums, len(model.values)
    by, share = model.components / np.sqrt(model.values), model.values / model.trace
    error = model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("_x"))
            # n * x - S need not fit a machine word, nor its square: whole numbers of any size, in slices.
            deviation = deviations(x, n, sums)
            each = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), n)), pa.array([deviation[i] for i in each], pa.decimal128(38, 0)),
                    pa.array((centred(x, n, sums) @ by).ravel()), pa.array(np.tile(share, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                names=["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Exact ``sum((n * x - sums)^2)`` of each row, in machine words where they are sure to hold it."""
    # Entries less the whole part of the mean are small; what is left of n * x - S keeps their size times n.
    whole, rest = np.divmod(sums, n)
    most = (int(np.abs(x - whole).max()) + 1) * int(n)
    if most * most * x.shape[1] < 1 << 63:
        away = n * (x - whole) - rest
        return (away * away).sum(axis=1).tolist()
    away = int(n) * (x - whole).astype(object) - rest.astype(object)
    return (away * away).sum(axis=1).tolist()
