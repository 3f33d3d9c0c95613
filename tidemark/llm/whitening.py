"""Embedding whitening by incremental eigendecomposition and a distributed Rayleigh-Ritz refinement.

Method
------
A task keeps a count, exact sums, a mean and the eigendecomposition of the scatter of the rows it has read. A further row moves the mean
and adds a rank-one term to the scatter, along the row's distance from the mean. Rows come in blocks: a block is first turned into as few
rows as a vector has entries, which have the block's scatter, so a block costs that many updates. The eigenvalues after such an update are
the roots of a secular equation, one between each two neighbouring eigenvalues; they are found for all at once by rational
interpolation inside brackets. Directions in which the row has nothing, and pairs of equal eigenvalues after a
rotation, are deflated: they stay as they are. Eigenvectors come from the values that make the found roots
exact, so they stay orthogonal.

Spectra of tasks are combined in a tree: each eigenpair of the one is a rank-one update of the other, and one more carries the
distance of the means. The result is an orthonormal basis close to the eigenvectors. Rayleigh-Ritz then makes it
exact: the covariance of all rows in that basis is summed over the table, with the exact mean, and its small
eigenproblem turns the basis. Nothing larger than a matrix of one row's length squared reaches a task or the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import dimension, usable
from tidemark.session import stage

_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + rho * z z'`` for rising, distinct ``d``, ``z`` without zeros and ``rho > 0``.

    Also returns ``gaps``: the pole i less the root j, taken from the nearer pole so that small ones keep their digits.
    """
    n, weight = len(d), z * z
    width = np.r_[d[1:] - d[:-1], 1.001 * rho * weight.sum()]  # the last bracket ends behind what the trace allows
    following = np.r_[weight[1:], 0.0]
    middle = d + width / 2
    apart = np.subtract.outer(d, middle)
    f = 1 / rho + weight @ (1 / apart)
    # measure from the nearer pole; the last root has one on its left only
    near = f >= 0
    near[-1] = True
    base = np.where(near, d, d + width)
    poles = np.subtract.outer(d, base)
    low_half = f >= 0
    lo, hi = np.where(near, 0.0, -width), np.where(near, width, 0.0)
    at = middle - base
    own, other = lo, hi
    lo, hi = np.where(low_half, lo, at), np.where(low_half, at, hi)
    # the root if all other poles kept the value that they have in the middle
    with np.errstate(all="ignore"):
        rest = f + (weight - following) / (width / 2)
        both, sign = weight + following, np.where(near, 1.0, -1.0)
        p, q = sign * rest * width + both, np.where(near, weight, following) * width
        root = np.sqrt(np.abs(p * p - sign * 4 * q * rest))
        start = np.where(near, np.where(p > 0, 2 * q / (p + root), (p - root) / (2 * rest)), np.where(p < 0, 2 * q / (p - root), -(p + root) / (2 * rest)))
    tau = np.where(np.isfinite(start) & (start > lo) & (start < hi), start, (lo + hi) / 2)
    for _ in range(60):
        part = 1 / (poles - tau)
        value = 1 / rho + weight @ part
        done = np.abs(value) <= 16 * n * _EPS * (1 / rho + weight @ np.abs(part))
        if done.all():
            break
        rise = value < 0
        lo, hi = np.where(rise, tau, lo), np.where(rise, hi, tau)
        # a rational with the two poles around the root, the nearer one with its own weight, of the same value and slope
        np.square(part, out=part)
        slope = weight @ part
        a, b = own - tau, other - tau
        p, q = (a + b) * value - a * b * slope, a * b * value
        with np.errstate(all="ignore"):
            c = value - np.where(near, b, a) * slope - np.where(near, -width * weight / (a * a), width * following / (b * b))
            c[-1] = value[-1] + a[-1] * -slope[-1]
            root = np.sqrt(np.abs(p * p - 4 * q * c))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            step[-1] = a[-1] + a[-1] * a[-1] * slope[-1] / c[-1]
        new = tau + step
        inside = np.isfinite(new) & (new > lo) & (new < hi)
        # a step that rounds to nothing has arrived
        done |= np.abs(step) <= 4 * _EPS * np.abs(tau)
        if done.all():
            break
        tau = np.where(done, tau, np.where(inside, new, (lo + hi) / 2))
    gaps = poles - tau
    # a root may fall on a pole in rounding
    gaps[gaps == 0] = -np.finfo(float).tiny
    return base + tau, gaps


def rank_one(values: np.ndarray, vectors: np.ndarray, rho: float, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, rising, and eigenvectors after adding ``rho * x x'``, ``rho >= 0``."""
    z = vectors.T @ x
    length = float(np.sqrt(z @ z))
    if rho <= 0 or not length > 0:
        return values, vectors
    rho, z = rho * length * length, z / length
    scale = max(float(np.abs(values).max()), rho)
    small = 8 * _EPS * scale
    active = rho * np.abs(z) > small
    order = np.flatnonzero(active)
    close = np.flatnonzero(np.diff(values[order]) * np.abs(z[order[1:]] * z[order[:-1]]) <= small)
    if len(close):
        values, vectors, z = values.copy(), vectors.copy(), z.copy()
        at = order[0]
        for k in order[1:]:
            if (values[k] - values[at]) * abs(z[k] * z[at]) <= small:
                # rotate the pair so that the first has no part in the update
                r = float(np.hypot(z[k], z[at]))
                c, s = z[k] / r, z[at] / r
                first, second = vectors[:, at].copy(), vectors[:, k].copy()
                vectors[:, at], vectors[:, k] = c * first - s * second, s * first + c * second
                one, two = values[at], values[k]
                values[at], values[k] = c * c * one + s * s * two, s * s * one + c * c * two
                z[at], z[k] = 0.0, r
                active[at] = False
            at = k
        active &= rho * np.abs(z) > small
        order = np.flatnonzero(active)
        order = order[np.argsort(values[order], kind="stable")]
    if not len(order):
        return values, vectors
    d, w = values[order], z[order]
    if (np.diff(d) <= 0).any():
        # rotations left two values equal; part them by less than they are known to
        d = d + np.arange(len(d)) * _EPS * scale
    roots, gaps = secular_roots(d, w, rho)
    # the update that has exactly these roots
    apart = d[None] - d[:, None]
    np.fill_diagonal(apart, 1.0)
    exact = np.sqrt(np.abs(np.prod(-gaps / apart, axis=1)))
    q = (np.where(w < 0, -exact, exact)[:, None]) / gaps
    q /= np.sqrt((q * q).sum(axis=0))
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[order], new_vectors[:, order] = roots, vectors[:, order] @ q
    rising = np.argsort(new_values, kind="stable")
    return new_values[rising], new_vectors[:, rising]


@dataclass
class Spectrum:
    """Count, exact sums, mean, and eigenpairs of the scatter around the mean, values rising."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim, object), np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray, block: int = 4096) -> None:
        """Rows of whole numbers, ``block`` at a time.

        A block of more rows than entries is turned by a QR decomposition into as many rows as there are entries, around its own mean and of the
        same scatter; these, and the distance of the means, are the rank-one updates. Rows of smaller blocks count one by one.
        """
        for at in range(0, len(x), max(block, 1)):
            part = x[at : at + max(block, 1)].astype(np.float64)
            if len(part) <= 2 * part.shape[1]:
                for row in part:
                    self._shift(row, 1)
                continue
            mean = part.mean(axis=0)
            for row in np.linalg.qr(part - mean, mode="r"):
                self.values, self.vectors = rank_one(self.values, self.vectors, 1.0, row)
            self._shift(mean, len(part))
        self.sums = self.sums + x.sum(axis=0).astype(object)

    def _shift(self, mean: np.ndarray, n: int) -> None:
        """Takes in ``n`` rows of a mean; their scatter around it is counted apart."""
        away = mean - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, self.n * n / (self.n + n), away)
        self.n += n
        self.mean = self.mean + away * (n / self.n)

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            self.values, self.vectors = rank_one(self.values, self.vectors, max(float(value), 0.0), vector)
        self._shift(other.mean, other.n)
        self.sums = self.sums + other.sums

    def row(self) -> dict:
        return {"n": self.n, "sums": [str(s) for s in self.sums], "mean": self.mean.tobytes(), "eigenvalues": self.values.tobytes(), "vectors": np.ascontiguousarray(self.vectors).tobytes()}

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        mean, values = np.frombuffer(row["mean"]), np.frombuffer(row["eigenvalues"])
        return cls(row["n"], np.array([int(s) for s in row["sums"]], object), mean, values, np.frombuffer(row["vectors"]).reshape(len(mean), -1))


_SPECTRUM = pa.schema([("n", pa.int64()), ("sums", pa.list_(pa.string())), ("mean", pa.binary()), ("eigenvalues", pa.binary()), ("vectors", pa.binary())])
_SPECTRUM_DDL = "n long, sums array<string>, mean binary, eigenvalues binary, vectors binary"


def _tree(rows: DataFrame, combine: Callable[[list[dict]], dict], schema: pa.Schema, ddl: str, fan: int = 16) -> dict | None:
    """One row out of a table with one small row per task: ``fan`` at a time, in as many rounds as it takes."""
    rows = stage(rows.withColumn("slot", F.monotonically_increasing_id()), "partials")
    while (n := rows.count()) > fan:
        # numbers without gaps, so that every group is full
        parts = -(-n // fan)

        def merged(t: pa.Table) -> pa.Table:
            return pa.Table.from_pylist([combine(t.sort_by("slot").to_pylist())], schema=schema)

        dealt = rows.withColumn("party", F.pmod(F.xxhash64("slot"), F.lit(parts)))
        rows = stage(dealt.groupBy("party").applyInArrow(merged, ddl).withColumn("slot", F.monotonically_increasing_id()), "partials")
    last = rows.orderBy("slot").collect()
    return combine([r.asDict() for r in last]) if last else None


def _merged(rows: list[dict]) -> dict:
    first = Spectrum.of(rows[0])
    for r in rows[1:]:
        first.merge(Spectrum.of(r))
    return first.row()


@dataclass(frozen=True)
class Whitening:
    """What one pass over the table needs: whole-number vectors, their exact sums, and eigenpairs, values falling."""

    dim: int
    scale: float
    shift: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def integers(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which rows take part, and ``floor(scale * c) + shift`` of their entries."""
        good, entries = usable(column, self.dim)
        return good, np.clip(np.floor(entries * self.scale), -_MOST, _MOST).astype(np.int64) + self.shift

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact: 64-bit integers where they fit, else Python's."""
        room = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        if room < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


#: Scaled entries are held within this magnitude.
_MOST = 1 << 40


def _covariance(rows: DataFrame, model: Whitening, basis: np.ndarray) -> np.ndarray:
    """The covariance of ``basis' (x - mean)`` over all rows, divisor n."""
    width = basis.shape[1]
    schema, ddl = pa.schema([("c", pa.binary())]), "c binary"

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width)), False
        for batch in batches:
            good, x = model.integers(batch.column(0))
            if good.any():
                y = model.centred(x) @ basis
                total, seen = total + y.T @ y, True
        if seen:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], schema=schema)

    def summed(parts: list[dict]) -> dict:
        return {"c": sum(np.frombuffer(r["c"]) for r in parts).tobytes()}

    got = _tree(rows.select("v").mapInArrow(of, ddl), summed, schema, ddl)
    return np.frombuffer(got["c"]).reshape(width, width) / model.n if got else np.zeros((width, width))


def fit_whitening(rows: DataFrame, vector_col: str = "embedding", scale: float = 1024.0, shift: int = 100_000) -> Whitening | None:
    """Eigenpairs of the covariance of all rows that take part; None where there are none."""
    dim = dimension(rows, vector_col)
    vectors = _vectors(rows, vector_col)
    start = Whitening(dim, scale, shift, 0, (), np.zeros(0), np.zeros((0, 0)), 0.0)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(dim)
        for batch in batches:
            own.add(start.integers(batch.column(0))[1])
        if own.n:
            yield pa.RecordBatch.from_pylist([own.row()], schema=_SPECTRUM)

    if not dim or (got := _tree(vectors.mapInArrow(of, _SPECTRUM_DDL), _merged, _SPECTRUM, _SPECTRUM_DDL)) is None:
        return None
    spectrum = Spectrum.of(got)
    basis, _ = np.linalg.qr(spectrum.vectors)
    model = Whitening(dim, scale, shift, spectrum.n, tuple(int(s) for s in spectrum.sums), spectrum.values, basis, 0.0)
    # Rayleigh-Ritz: the covariance in the basis, whose own eigenvectors turn the basis
    inner = _covariance(vectors, model, basis)
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    vectors_, values = basis @ turn[:, ::-1], np.maximum(values[::-1], 0.0)
    return Whitening(dim, scale, shift, model.n, model.sums, values, vectors_, float(np.trace(inner)))


def _vectors(rows: DataFrame, vector_col: str, *others: str) -> DataFrame:
    return rows.select(F.col(vector_col).cast("array<double>").alias("v"), *others).where("v is not null")


_OUT = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0, shift: int = 100_000, components: int = 8) -> DataFrame:
    """``vec_id`` (under its own name), ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    An entry c counts as ``floor(scale * c) + shift``. One row for each vector and component, components numbered from 1 by
    falling eigenvalue. ``deviation``: the exact sum of ``(n * x - sum) ** 2`` over the entries, as a decimal of 38 digits. ``explained``: the component's share of
    the variance. ``identity_error``: the largest absolute entry of the covariance of ``whitened``, over all rows, less the identity.

    Null vectors, null or non-finite entries and vectors that are not of the table's commonest length are dropped. A null id keeps its rows;
    rows that repeat count each. A component without variance (one row, or entries that never change) has a null
    ``whitened`` and no part in ``identity_error``; ``explained`` is 0 where nothing varies. Fewer entries than ``components`` give fewer
    components. Scaled entries are held within 2 ** 40. Further columns are ignored; an empty table gives no rows.
    """
    schema = f"{id_col} long, " + _OUT.split(", ", 1)[1]
    model = fit_whitening(rows, vector_col, scale, shift)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    count = min(components, model.dim)
    # what rounding alone gives is no variance
    varies = model.values[:count] > model.dim * _EPS * max(model.values[0], _EPS)
    basis = np.where(varies, model.vectors[:, :count] / np.sqrt(np.where(varies, model.values[:count], 1.0)), 0.0)
    explained = model.values[:count] / model.trace if model.trace > 0 else np.zeros(count)
    spread = _covariance(_vectors(rows, vector_col), model, basis)[varies][:, varies]
    error = float(np.abs(spread - np.eye(len(spread))).max(initial=0.0))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, x = model.integers(batch.column(0))
            rows_ = int(good.sum())
            if not rows_:
                continue
            away = model.deviations(x)
            if away.dtype != object and int(np.abs(away).max()) ** 2 * model.dim < 1 << 63:
                deviation = pa.array((away * away).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                deviation = pa.array([Decimal(int(v)) for v in (away.astype(object) ** 2).sum(axis=1)], pa.decimal128(38, 0))
            each = np.repeat(np.arange(rows_), count)
            white = ((away / model.n).astype(np.float64) @ basis).ravel()
            yield pa.record_batch(
                [
                    batch.column(1).filter(pa.array(good)).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows_)),
                    pa.array(np.full(rows_ * count, model.n, np.int64)),
                    deviation.take(pa.array(each)),
                    pa.array(white, mask=~np.tile(varies, rows_)),
                    pa.array(np.tile(explained, rows_)),
                    pa.array(np.full(rows_ * count, error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    named = rows.select(F.col(vector_col).cast("array<double>").alias("v"), F.col(id_col).cast("long").alias("id"))
    return named.where("v is not null").mapInArrow(of, _OUT).withColumnRenamed("id", id_col)
