"""Embedding whitening with a covariance found by polarisation.

Entries become integers x.  After one pass for the sums S, a second pass
centres every entry by the integer part of its dimension's mean and adds up,
exactly, the squares of each centred dimension and of each sum of two
dimensions.  With Var the variance,

    Cov(i, j) = (Var(i + j) - Var(i) - Var(j)) / 2,

so these squares give every covariance as an exact ratio of integers, rounded
once to a double; ``eigh`` of that matrix gives the components.  The rest of
the mean (its fraction) is taken off exactly, on the integers.  Partial sums
travel as (dimension, dimension) rows of two exact decimals and are added by
Spark; the driver holds one matrix of dimension x dimension.

Vectors of each length form a fit list of their own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000  # fixed values: x = floor(1024 * c) + 100000
LIMIT = 1 << 60  # floor(1024 * c) stays within this size; larger entries count as the limit
CHUNK = 2048  # vectors squared at once
_PART = 60  # bits of the lower of the two exact parts of a sum

SUMS_SCHEMA = "d int, i int, j int, high decimal(38,0), low decimal(38,0)"


def finite_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): rows whose vector is not null and holds neither nulls nor non-finite entries."""
    v = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return v.where(F.col("v").isNotNull() & good)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, x matrix of whole numbers) for each vector length in a batch of (vec_id, v)."""
    col = batch.column(1)
    lens = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(col.flatten(), np.float64)
    starts = np.cumsum(lens) - lens
    for d in np.unique(lens).tolist():
        if d:
            at = np.flatnonzero(lens == d)
            c = flat[starts[at][:, None] + np.arange(d)]
            with np.errstate(over="ignore"):
                yield d, at, np.clip(np.floor(SCALE * c), -LIMIT, LIMIT).astype(np.int64) + SHIFT


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums of a matrix of int64."""
    if int(np.abs(x).max(initial=0)) * len(x) < 1 << 62:
        return x.sum(0).tolist()
    return [int(v) for v in x.astype(object).sum(0)]


def square_sums(y: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(i, j, sum of (y_i + y_j)^2) for i < j, and (i, i, sum of y_i^2): exact."""
    d = y.shape[1]
    top = 2 * int(np.abs(y).max(initial=0))
    exact_in_doubles = top * top * len(y) < 1 << 53
    y = y.astype(np.float64) if exact_in_doubles else y.astype(object)
    for i in range(d):
        z = np.concatenate([y[:, i:i + 1], y[:, i + 1:] + y[:, i:i + 1]], axis=1)
        s = np.einsum("rc,rc->c", z, z) if exact_in_doubles else (z * z).sum(0)
        for j, v in enumerate(s.tolist(), i):
            yield i, j, int(v)


def _summed(vectors: DataFrame, part: Callable[[int, np.ndarray], Iterator[tuple[int, int, int]]]) -> dict:
    """{length: {(i, j): sum}} of the whole numbers ``part`` gives for chunks of vectors of a length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], int] = defaultdict(int)
        for b in batches:
            for d, _, x in by_length(b):
                for lo in range(0, len(x), CHUNK):
                    for i, j, v in part(d, x[lo:lo + CHUNK]):
                        sums[d, i, j] += v
        if sums:
            keys = list(sums)
            kinds = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[c] for k in keys], pa.int32()) for c in range(3)]
                + [pa.array([Decimal(sums[k] >> _PART) for k in keys], kinds),
                   pa.array([Decimal(sums[k] & ((1 << _PART) - 1)) for k in keys], kinds)], ["d", "i", "j", "high", "low"])

    rows = vectors.mapInArrow(run, SUMS_SCHEMA).groupBy("d", "i", "j").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low")).toArrow().to_pylist()
    out: dict[int, dict[tuple[int, int], int]] = defaultdict(dict)
    for r in rows:
        out[r["d"]][r["i"], r["j"]] = (int(r["high"]) << _PART) + int(r["low"])
    return out


@dataclass
class Whitener:
    """What the fit list of one vector length has learnt."""

    n: int
    sums: list[int]  # S
    base: np.ndarray  # integer part of each mean
    rest: np.ndarray  # fraction of each mean
    covariance: np.ndarray
    axes: np.ndarray  # dimension x component
    values: np.ndarray  # eigenvalue by component
    explained: np.ndarray
    usable: np.ndarray  # components with a variance above rounding

    def whiten(self, x: np.ndarray) -> np.ndarray:
        scale = np.sqrt(np.where(self.usable, self.values, 1.0))
        return ((x - self.base).astype(np.float64) - self.rest) @ self.axes / scale

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)^2 for each vector, exact."""
        top = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if top * top * x.shape[1] < 1 << 62:
            z = self.n * x - np.array(self.sums, np.int64)
            return (z * z).sum(1).tolist()
        z = self.n * (x - self.base).astype(object) - np.array([s - self.n * int(b) for s, b in zip(self.sums, self.base)], object)
        return [int(v) for v in (z * z).sum(1)]


def covariances(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> list[list[int]]:
    """n^2 times the covariance matrix, exact, from the square sums of centred dimensions and of their pair sums.

    ``rest`` holds each dimension's sum after centring.
    """
    d = len(rest)
    var = {(i, j): n * q - (rest[i] + (rest[j] if i != j else 0)) ** 2 for (i, j), q in squares.items()}
    out = [[0] * d for _ in range(d)]
    for (i, j), v in var.items():
        out[i][j] = out[j][i] = v if i == j else (v - var[i, i] - var[j, j]) // 2
    return out


def fit(vectors: DataFrame, components: int = 8) -> dict[int, Whitener]:
    """A ``Whitener`` for each vector length of (vec_id, v)."""
    def count_and_sum(d: int, x: np.ndarray) -> Iterator[tuple[int, int, int]]:
        yield -1, -1, len(x)
        for i, s in enumerate(exact_sums(x)):
            yield i, i, s

    first = _summed(vectors, count_and_sum)
    counts = {d: s.pop((-1, -1)) for d, s in first.items()}
    sums = {d: [s[i, i] for i in range(d)] for d, s in first.items()}
    base = {d: np.array([v // counts[d] for v in s], np.int64) for d, s in sums.items()}
    squares = _summed(vectors, lambda d, x: square_sums(x - base[d])) if first else {}
    out = {}
    for d, n in counts.items():
        rest = [s - n * int(b) for s, b in zip(sums[d], base[d])]
        whole = covariances(n, rest, squares[d])
        cov = np.array([[v / (n * n) for v in row] for row in whole], np.float64)
        values, axes = np.linalg.eigh(cov)
        values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
        axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
        trace = sum(whole[i][i] for i in range(d)) / (n * n)
        usable = values > d * np.finfo(np.float64).eps * max(float(values[0]), 0.0)
        out[d] = Whitener(n, sums[d], base[d], np.array([r / n for r in rest]), cov, axes, values,
                          values / trace if trace > 0 else np.full(len(values), np.nan), usable)
    return out


def identity_errors(vectors: DataFrame, fitted: dict[int, Whitener]) -> dict[int, float | None]:
    """By vector length: the largest absolute entry of the whitened vectors' covariance minus the identity.

    Only usable components count; None where there is none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in by_length(b):
                z = fitted[d].whiten(x)
                z = np.concatenate([z, np.ones((len(z), 1))], axis=1)
                sums[d] = sums.get(d, 0) + z.T @ z
        rows = [(d, i, j, float(v)) for d, m in sums.items() for (i, j), v in np.ndenumerate(m)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], pa.float64() if c == 3 else pa.int32()) for c in range(4)],
                ["d", "i", "j", "v"])

    rows = vectors.mapInArrow(run, "d int, i int, j int, v double").groupBy("d", "i", "j").agg(
        F.sum("v").alias("v")).collect()
    out: dict[int, float | None] = {}
    for d, w in fitted.items():
        k = len(w.values)
        m = np.zeros((k + 1, k + 1))
        for r in rows:
            if r["d"] == d:
                m[r["i"], r["j"]] = r["v"]
        mean = m[:k, k] / w.n
        cov = m[:k, :k] / w.n - np.outer(mean, mean) - np.eye(k)
        out[d] = float(np.abs(cov[np.ix_(w.usable, w.usable)]).max()) if w.usable.any() else None
    return out


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = 8) -> DataFrame:
    """One row per kept vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error, ...).

    Rows whose vector is null, or holds nulls or non-finite entries, are
    dropped; an empty vector has no components and so no rows.  Repeated
    rows and null vec_ids stay as rows of their own.  Vectors of each length
    are fitted apart.  A component without variance (all vectors equal, or
    fewer vectors than components) has a null ``whitened``; ``explained`` is
    null where nothing varies at all.  ``deviation`` is exact; where it does not
    fit in 64 bits it is null, and ``deviation_text`` (else null) holds its digits.
    Only vec_id and the vector are read.
    """
    vectors = finite_vectors(embeddings, vector)
    fitted = fit(vectors, components)
    errors = identity_errors(vectors, fitted) if fitted else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            for d, at, x in by_length(b):
                w = fitted[d]
                k = len(w.values)
                rows = np.repeat(np.arange(len(at)), k)
                part = np.tile(np.arange(k), len(at))
                z = w.whiten(x).ravel()
                dev = w.deviations(x)
                wide = [v >= 1 << 63 for v in dev]
                long = pa.array([None if o else v for v, o in zip(dev, wide)], pa.int64()).take(pa.array(rows))
                text = pa.array([str(v) if o else None for v, o in zip(dev, wide)], pa.string()).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at[rows])), pa.array((part + 1).astype(np.int32)), pa.array(np.full(len(rows), w.n, np.int64)),
                     long, pa.array(z, mask=~w.usable[part]), pa.array(w.explained[part], mask=np.isnan(w.explained[part])),
                     pa.array([errors[d]] * len(rows), pa.float64()), text],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_text"])

    return vectors.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, "
                                   "explained double, identity_error double, deviation_text string")
