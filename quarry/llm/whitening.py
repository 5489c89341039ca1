"""Embedding whitening: float32 eigenvectors refined in higher precision.

Entries c become whole numbers floor(64 c) + 1000000, so that sums and products are exact
and the same however Spark partitions the rows. Two passes in Arrow batches give the sums
and the products of the entries; every entry is centred before it is multiplied, on
the whole part of its dimension's mean, and what the fraction adds is taken off in
integers. Partial matrices are added up by Spark, one row per cell; only the finished
matrix (dimension squared) reaches the driver.

There its eigenvectors are found in float32 and corrected by the iteration of Ogita and
Aishima (matrix products only) in extended precision. Eigenvalues that lie closer than the
iteration can tell apart form clusters; each is resolved by a sub-solve of the matrix shifted
by the cluster's centre and projected on its vectors, after which the iteration goes on.

Defined cases: a vector that is null or holds a null, NaN or infinite entry is left out; so
is one of another length than most (the longer of equally frequent lengths wins), as it
has no place in the space. Repeated rows all count. A component whose eigenvalue is zero to
working precision cannot be scaled: it is listed, whitened is null. Shares are null where the
total variance is zero. A deviation beyond a long is null. Entries of 2^56 or more are refused
with an error. Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from quarry.llm.common import fresh, in_arrow, named

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
LARGEST = 2.0 ** 56
EXACT = 2 ** 53         # whole numbers up to here are exact in float64
HELD_SUMS = 1 << 20     # sums a task holds before it hands them on
WIDE = pa.decimal128(38, 0)


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths (-1 for null), starts and the entries in one run, null entries as NaN."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    entries = pc.fill_null(column.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    return lengths, starts, entries


def quantised(c: np.ndarray) -> np.ndarray:
    if c.size and np.abs(c).max() >= LARGEST:
        raise ValueError("an embedding has an entry of 2^56 or more, which does not fit the whole numbers used here")
    return np.floor(c * SCALE).astype(np.int64) + OFFSET


def of_length(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the usable vectors of one length, and their whole-number entries."""
    lengths, starts, entries = vectors(column)
    rows = np.flatnonzero(lengths == length)
    c = entries[starts[rows][:, None] + np.arange(length)[None, :]]
    good = np.isfinite(c).all(axis=1)
    return rows[good], quantised(c[good])


def _wide(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], WIDE)


def _sums(df: DataFrame) -> DataFrame:
    """n, sum, least and greatest entry for each length and dimension."""
    def batches(it):
        held: dict[int, list] = {}

        def given():
            for length, (n, total, low, high) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()), pa.array([n] * length, pa.int64()),
                     _wide(total), pa.array(low), pa.array(high)], names=["length", "dim", "n", "total", "low", "high"])
            held.clear()

        for batch in it:
            lengths = vectors(batch.column(0))[0]
            for length in np.unique(lengths[lengths > 0]).tolist():
                x = of_length(batch.column(0), length)[1]
                if len(x):
                    now = [len(x), x.astype(object).sum(axis=0) if np.abs(x).max() > 2 ** 62 // len(x) else x.sum(axis=0).astype(object), x.min(axis=0), x.max(axis=0)]
                    n, total, low, high = held.get(length, (0, np.zeros(length, object), now[2], now[3]))
                    held[length] = [n + now[0], total + now[1], np.minimum(low, now[2]), np.maximum(high, now[3])]
            if sum(held) > HELD_SUMS:
                yield from given()
        yield from given()

    parts = in_arrow(df, batches, "length int, dim int, n long, total decimal(38,0), low long, high long")
    return parts.groupBy("length", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))


def products(y: np.ndarray) -> np.ndarray:
    """y'y, exactly: by float64 products of blocks small enough that no sum is rounded."""
    top = int(np.abs(y).max()) if y.size else 0
    if top * top >= EXACT:
        z = y.astype(object)
        return z.T @ z
    step, out = min(max(len(y), 1), EXACT // max(top * top, 1)), np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), step):
        part = y[at:at + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def _cross(df: DataFrame, whole: np.ndarray) -> DataFrame:
    """Sums over all rows of products of entries less ``whole``, for cells i <= j."""
    d = len(whole)

    def batches(it):
        total = np.zeros((d, d), object)
        for batch in it:
            total = total + products(of_length(batch.column(0), d)[1] - whole)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _wide(total[i, j])], names=["i", "j", "total"])

    return in_arrow(df, batches, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))


# ------------------------------------------------------------- eigenvectors

def _extended(value: Fraction) -> np.longdouble:
    high = float(value)
    return np.longdouble(high) + np.longdouble(float(value - Fraction(high)))


def clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Indices of values that chains of gaps up to ``width`` hold together, in groups of two or more."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def refined(a: np.ndarray, x: np.ndarray, most: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of ``a`` (extended precision) from the approximate vectors ``x``."""
    d, unit = len(a), np.eye(len(a), dtype=np.longdouble)
    norm = np.sqrt((a * a).sum())
    x = x.astype(np.longdouble)
    apart = None
    for _ in range(most):
        r, s = unit - x.T @ x, x.T @ (a @ x)
        s = (s + s.T) / 2  # rounding aside it is; over small gaps the difference would count
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        width = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        gap = value[None, :] - value[:, None]
        far = np.abs(gap) > width
        np.fill_diagonal(far, False)
        change = np.where(far, (s + value[None, :] * r) / np.where(far, gap, 1), r / 2)
        x = x + x @ change
        close = clusters(value, width)
        for group in close:
            # Sub-solve: the shifted matrix on the cluster's vectors is as small as the cluster is
            # wide, so float64 resolves it far below the rounding of the whole matrix.
            v = x[:, group]
            centre = value[group].mean()
            t = v.T @ (a @ v) - centre * (v.T @ v)
            size = np.abs(t).max()
            if size > 0:
                turn = np.linalg.eigh(((t + t.T) / (2 * size)).astype(np.float64))[1].astype(np.longdouble)
                # The turn itself is orthogonal to float64 only; the next step's r corrects that.
                x[:, group] = v @ turn
        size = np.abs(change).max()
        if size < 1e-17 or (apart is not None and size < 1e-13 and size >= apart / 2):
            break
        apart = size
    for _ in range(2):  # orthogonal to the last digit, whatever small gaps left
        x = x + x @ (unit - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(axis=0))
    value = np.einsum("ij,ij->j", x, a @ x)
    return value, x


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit vectors (columns; the largest entry is positive), to double precision."""
    size = np.abs(a).max() if a.size else 0
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    first = np.linalg.eigh((a / size).astype(np.float32))[1]
    value, x = refined(a / size, first)
    order = np.argsort(-value, kind="stable")
    value, x = value[order] * size, x[:, order]
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(a))] < 0, -1, 1)
    return value.astype(np.float64), x.astype(np.float64)


# -------------------------------------------------------------------- model

@dataclass
class Whitening:
    """x is centred as (x - whole) - rest / n; ``values`` fall, ``vectors`` are columns."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    reach: int
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def dimension(self) -> int:
        return len(self.whole)

    def usable(self) -> np.ndarray:
        return self.values > self.dimension * 2.0 ** -50 * max(float(self.values.max(initial=0.0)), 0.0)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components; NaN where the eigenvalue is zero."""
        centred = (x - self.whole).astype(np.float64) - self.rest / self.n
        good = self.usable()
        return centred @ self.vectors * np.where(good, 1 / np.sqrt(np.where(good, self.values, 1)), np.nan)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums over dimensions of (n x - S)^2; null beyond a long."""
        step = self.n * (self.reach + 1)
        if step * step * max(self.dimension, 1) < 2 ** 63:
            y = self.n * (x - self.whole) - self.rest
            return np.einsum("ij,ij->i", y, y).tolist()
        y = self.n * (x - self.whole).astype(object) - self.rest.astype(object)
        return [v if v < 2 ** 63 else None for v in (y * y).sum(axis=1).tolist()]


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors; None if there are none."""
    src = df.select(named(column).cast("array<double>").alias("v"))
    sums = _sums(src).where(F.col("n") > 0).persist()
    top = sums.where("dim = 0").orderBy(F.desc("n"), F.desc("length")).first()
    got = sums.where(F.col("length") == top["length"]).orderBy("dim").collect() if top else []
    sums.unpersist()
    if not got:
        return None
    n, d = top["n"], top["length"]
    total = [int(r["total"]) for r in got]
    whole = np.array([t // n for t in total], dtype=np.int64)
    rest = np.array([t % n for t in total], dtype=np.int64)
    reach = max(max(r["high"] - int(w), int(w) - r["low"]) for r, w in zip(got, whole, strict=True))
    a = np.zeros((d, d), dtype=np.longdouble)
    for r in _cross(src, whole).collect():
        i, j = r["i"], r["j"]
        a[i, j] = a[j, i] = _extended(Fraction(n * int(r["total"]) - int(rest[i]) * int(rest[j]), n * n))
    values, vecs = eigen(a)
    return Whitening(n, whole, rest, reach, float(np.trace(a)), values[:components], np.ascontiguousarray(vecs[:, :components]))


def whitened(df: DataFrame, model: Whitening | None, column: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) of the usable rows, then ``deviation`` and ``whitened``
    (an array with one entry per component)."""
    keep = list(df.columns) if keep is None else keep
    names = [fresh(df, "deviation"), fresh(df, "whitened")]
    src = df.select(*[named(c) for c in keep], named(column).cast("array<double>").alias(fresh(df, "__vector")))
    kind = df.select(*[named(c) for c in keep]).schema.add(names[0], "long").add(names[1], ArrayType(DoubleType()))
    if model is None:
        return df.sparkSession.createDataFrame([], kind)

    def batches(it):
        for batch in it:
            rows, x = of_length(batch.column(len(keep)), model.dimension)
            w = model.project(x)
            entries = pa.array(w.reshape(-1), from_pandas=True)
            ends = np.arange(len(rows) + 1, dtype=np.int32) * w.shape[1]
            kept = pa.Table.from_batches([batch.select(list(range(len(keep))))]).take(pa.array(rows)) if keep else None
            columns = [kept.column(i).combine_chunks() for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(model.deviation(x), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), entries)],
                                             names=[f.name for f in kind])

    return in_arrow(src, batches, kind)


def identity_error(df: DataFrame, model: Whitening | None, column: str = "embedding") -> float | None:
    """Largest entry, by size, of the covariance of the whitened rows minus the identity."""
    if model is None or not model.usable().any():
        return None
    good = np.flatnonzero(model.usable())

    def batches(it):
        total, ones = np.zeros((len(good), len(good))), np.zeros(len(good))
        for batch in it:
            w = model.project(of_length(batch.column(0), model.dimension)[1])[:, good]
            total, ones = total + w.T @ w, ones + w.sum(axis=0)
        i, j = np.triu_indices(len(good))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, np.arange(len(good))), pa.int32()), pa.array(np.append(j, np.full(len(good), -1)), pa.int32()),
                                          pa.array(np.append(total[i, j], ones))], names=["i", "j", "total"])

    src = df.select(named(column).cast("array<double>").alias("v"))
    got = {(r["i"], r["j"]): r["total"] for r in in_arrow(src, batches, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    # The rows are centred before they are projected; what rounding leaves of their means is taken off.
    mean = {i: got[i, -1] / model.n for i in range(len(good))}
    return max(abs(t / model.n - mean[i] * mean[j] - (i == j)) for (i, j), t in got.items() if j >= 0)
