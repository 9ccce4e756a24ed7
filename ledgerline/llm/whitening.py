"""Whitening of embeddings through singular values of the centred rows.

Entries become integers x = floor(scale * c) + shift. The fit list is each distinct integer vector once.

* **Blockwise QR.** Each task reduces its centred rows, a block at a time, to one triangular factor R; the factors
  of all tasks are stacked and reduced again, ``FAN`` at a time, until one d x d factor is left. The covariance
  is never formed, so small singular values keep their digits.
* **Householder bidiagonalisation** of R gives B with R = U B V'.
* **dqds.** The differential qd algorithm with shifts finds the singular values of B to high relative accuracy. The shift
  is a Newton bound, 1 / sum(1 / d) over the quantities d of an unshifted sweep, which never exceeds the least
  eigenvalue.
* **Twisted factorisations.** For each value the stationary and the progressive transform of B'B meet at the index with
  the least residue, and two short recurrences give the vector; close values are told apart by inverse iteration
  with orthogonalisation. V carries the vector back to a whitening direction.

Only numbers whose size depends on the dimension alone (sums, R, directions) reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import counted_stage_table, stage_table

SCALE, SHIFT = 64, 1_000_000      # fixed values of the contract
COMPONENTS = 16
FAN = 16
BLOCK_ROWS = 4096
LIMIT = 2.0 ** 46                 # larger entries have no exact integer here and count as unusable
_EPS = np.finfo(float).eps


# ------------------------------------------------------------------ the d x d solver (numpy)

def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, beta, alpha) with (I - beta v v') x = alpha e1."""
    norm = float(np.linalg.norm(x))
    if norm == 0 or not np.any(x[1:]):
        return np.zeros_like(x), 0.0, float(x[0])
    alpha = -math.copysign(norm, x[0])
    v = x.copy()
    v[0] -= alpha
    return v, 2.0 / float(v @ v), alpha


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of the upper bidiagonal B = U' r V."""
    a = np.array(r, float)
    d = a.shape[0]
    v_all = np.eye(d)
    for k in range(d):
        v, beta, alpha = _reflector(a[k:, k])
        if beta:
            a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
            a[k, k], a[k + 1:, k] = alpha, 0.0
        if k + 2 < d:
            v, beta, alpha = _reflector(a[k, k + 1:])
            if beta:
                a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ v, v)
                a[k, k + 1], a[k, k + 2:] = alpha, 0.0
                v_all[:, k + 1:] -= beta * np.outer(v_all[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v_all


def _least_bound(q: list[float], e: list[float]) -> float:
    """A lower bound of the least eigenvalue: 1 / trace of the inverse, from an unshifted sweep."""
    d, total = q[0], 0.0
    for i in range(len(q)):
        if d <= 0.0:
            return 0.0
        total += 1.0 / d
        if i + 1 < len(q):
            d = q[i + 1] * (d / (d + e[i]))
    return 1.0 / total


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform; None when the shift was too large."""
    new_q, new_e, d = [], [], q[0] - shift
    for i in range(len(e)):
        if d < 0.0:
            return None
        t = d + e[i]
        ratio = q[i + 1] / t
        new_q.append(t)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    return None if d < 0.0 else ([*new_q, d], new_e)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, falling."""
    if not len(diagonal):
        return np.empty(0)
    scale = max(float(np.abs(diagonal).max()), float(np.abs(above).max()) if len(above) else 0.0)
    if scale == 0.0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    todo = [([float(x) for x in (diagonal / scale) ** 2], [float(x) for x in (above / scale) ** 2], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        while True:
            # an off-diagonal entry that is nothing beside its neighbours splits the matrix
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= _EPS ** 2 * (sigma + q[i]) or e[i] <= _EPS ** 2 * (sigma + q[i + 1])
                        and e[i] <= _EPS * q[i]), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if len(q) == 1:
                found.append(sigma + q[0])
                break
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            shift = _least_bound(q, e)
            done = _sweep(q, e, shift)
            if done is None:
                shift *= 1 - 1e-8
                done = _sweep(q, e, shift)
            if done is None:
                shift = 0.0
                done = _sweep(q, e, shift)
            (q, e), sigma = done, sigma + shift
    return scale * np.sqrt(np.sort(np.array(found))[::-1])


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """The eigenvector of B'B at the eigenvalue ``value``: two factorisations that meet at the twist."""
    q, e, off = diagonal ** 2, above ** 2, diagonal[:-1] * above
    m, tiny = len(q), _EPS * max(float(np.max(diagonal ** 2)), value) * _EPS
    s, plus, p, minus = np.empty(m), np.empty(m), np.empty(m), np.empty(m)
    s[0] = -value
    for i in range(m):
        plus[i] = s[i] + q[i] or tiny
        if i + 1 < m:
            s[i + 1] = e[i] / plus[i] * s[i] - value
    p[m - 1] = q[m - 1] - value
    for i in range(m - 2, -1, -1):
        minus[i + 1] = e[i] + p[i + 1] or tiny
        p[i] = q[i] / minus[i + 1] * p[i + 1] - value
    residue = np.abs(s + p + value)
    k = int(np.argmin(np.where(np.isfinite(residue), residue, np.inf)))
    z = np.zeros(m)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -off[i] / plus[i] * z[i + 1]
    for i in range(k, m - 1):
        z[i + 1] = -off[i] / minus[i + 1] * z[i]
    return z / np.linalg.norm(z)


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray, close: float = 1e-3) -> np.ndarray:
    """Right singular vectors of the bidiagonal matrix for the falling singular ``values``, as columns."""
    b = np.diag(diagonal) + np.diag(above, 1)
    t = b.T @ b
    split = [0, *(np.flatnonzero(np.abs(above) <= _EPS * (np.abs(diagonal[:-1]) + np.abs(diagonal[1:]))) + 1), len(diagonal)]
    out: list[np.ndarray] = []
    group = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > close * values[i - 1]:
            group = i
        # in a matrix that falls apart, the part with this value has the vector
        best, least = None, math.inf
        for lo, hi in zip(split[:-1], split[1:], strict=True):
            z = np.zeros(len(diagonal))
            with np.errstate(all="ignore"):
                z[lo:hi] = _twisted(diagonal[lo:hi], above[lo:hi - 1], value ** 2)
            if np.all(np.isfinite(z)) and (wrong := float(np.linalg.norm(t @ z - value ** 2 * z))) < least:
                best, least = z, wrong
        z = np.ones(len(diagonal)) if best is None else best
        near = out[group:i]
        if near or least > 1e-10 * max(values[0] ** 2, 1e-300):
            rng = np.random.default_rng(i)
            shifted = t - value ** 2 * (1 + 4 * _EPS) * np.eye(len(t)) - _EPS * values[0] ** 2 * np.eye(len(t))
            for turn in range(4):
                for other in [*near, *near]:
                    z = z - (other @ z) * other
                if np.linalg.norm(z) < 1e-2:
                    z = rng.standard_normal(len(z))
                    continue
                z = np.linalg.solve(shifted, z / np.linalg.norm(z))
                z /= np.linalg.norm(z)
            for other in [*near, *near]:
                z = z - (other @ z) * other
            z /= np.linalg.norm(z)
        out.append(z)
    return np.array(out).T.reshape(len(diagonal), len(values))


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: whole means and their fractions, directions as columns, variances and shares."""

    n: int
    whole: np.ndarray
    part: np.ndarray
    rest: list[int]               # S - n * whole, exact
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.part

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum over dimensions of (n x - S)^2, exact; None beyond a long."""
        away = x - self.whole
        reach = self.n * (int(np.abs(away).max(initial=0)) + 1)
        if reach * reach * x.shape[1] < 2 ** 62:
            return ((self.n * away - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * int(a) - r) ** 2 for a, r in zip(row, self.rest, strict=True)) for row in away]
        return [v if v < 2 ** 63 else None for v in exact]


def solve(r: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(directions, variances, explained shares) from the triangular factor of n centred rows. Values that
    are nothing beside the greatest one have no direction."""
    diagonal, above, v = bidiagonalise(r)
    values = dqds(diagonal, above)
    keep = values[:components]
    keep = keep[keep > len(values) * _EPS * values[0]] if values[0] > 0 else keep[:0]
    axes = v @ directions(diagonal, above, keep)
    axes /= np.linalg.norm(axes, axis=0)
    return axes, keep ** 2 / n, keep ** 2 / float(np.sum(r * r))


# ------------------------------------------------------------------ on Spark

def usable(vector: Column) -> Column:
    """True for a vector without null, NaN, infinite or too large entries."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < LIMIT)), F.lit(False))


def as_integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(f"`{vector_col}`")
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    return vectors.where(usable(v) & (F.size(v) > 0)).select(F.col(f"`{id_col}`").alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dim)


def _sums(distinct: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(n, exact sums of each dimension). A task sends one row a dimension, in halves that cannot overflow."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(dim, np.int64), np.zeros(dim, np.int64), 0
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            high += (x >> 26).sum(axis=0)
            low += (x & ((1 << 26) - 1)).sum(axis=0)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(high), pa.array(low), pa.array([n] * dim)], names=["i", "high", "low", "n"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = distinct.mapInArrow(partial, "i long, high long, low long, n long").groupBy("i").agg(wide("high"), wide("low"), wide("n")).collect()
    if not rows:
        return 0, [0] * dim
    return int(rows[0]["n"]), [(int(r["high"]) << 26) + int(r["low"]) for r in sorted(rows, key=lambda r: r["i"])]


def _triangle(rows: np.ndarray, dim: int) -> np.ndarray:
    r = np.linalg.qr(rows, mode="r")
    return r if len(r) == dim else np.vstack([r, np.zeros((dim - len(r), dim))])


def _factor(distinct: DataFrame, dim: int, whole: np.ndarray, part: np.ndarray, fan: int, block_rows: int) -> np.ndarray:
    """R of all centred rows: one factor a task, then levels of ``fan`` factors."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r, seen = np.zeros((dim, dim)), False
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            for at in range(0, len(x), block_rows):
                r, seen = _triangle(np.vstack([r, (x[at:at + block_rows] - whole).astype(float) - part]), dim), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([r.tobytes()])], names=["part", "r"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([np.frombuffer(r).reshape(dim, dim) for r in pdf["r"]])
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "r": [_triangle(stacked, dim).tobytes()]})

    level, count = counted_stage_table(distinct.mapInArrow(reduce, "part long, r binary"), "whitening-factors")
    while count > 1:
        count = math.ceil(count / fan)
        level = level.withColumn("part", F.pmod(F.col("part"), F.lit(count))).groupBy("part").applyInPandas(merge, "part long, r binary")
    return np.frombuffer(level.collect()[0]["r"]).reshape(dim, dim)


def fit(distinct: DataFrame, dim: int, components: int = COMPONENTS, fan: int = FAN, block_rows: int = BLOCK_ROWS) -> Whitening | None:
    """The whitening of a written table of distinct integer vectors ``x`` of ``dim`` entries; None without rows."""
    n, sums = _sums(distinct, dim)
    if not n:
        return None
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    part = np.array([float(Fraction(r, n)) for r in rest])
    axes, variances, explained = solve(_factor(distinct, dim, whole, part, fan, block_rows), n, components)
    return Whitening(n, whole, part, rest, axes, variances, explained)


def identity_error(distinct: DataFrame, dim: int, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.variances)
    if not k:
        return 0.0
    i, j = (x.ravel() for x in np.indices((k, k + 1)))         # column k holds the sums

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            w = model.whiten(_matrix(batch.column(0), dim))
            total += w.T @ np.hstack([w, np.ones((len(w), 1))])
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "s"])

    total = np.zeros((k, k + 1))
    for row in distinct.mapInArrow(partial, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        total[row["i"], row["j"]] = row["s"]
    mean = total[:, k] / model.n                                # zero but for rounding
    return float(np.abs(total[:, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, dim: int | None = None,
           fan: int = FAN, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Defined cases: a vector that is null or empty, or holds null, NaN, infinite or larger entries than ``LIMIT`` (2^46), is
    dropped; so is one whose length isn't ``dim`` (by default the commonest length of the fit list, of equally common
    ones the greatest). Equal vectors count once in the fit and are all returned; null and
    repeated ids stay; a component without variance (fewer distinct vectors than dimensions, a constant dimension) cannot be
    scaled and has no rows; a deviation beyond a long is null; an empty table gives no rows; other columns are ignored.
    """
    rows = as_integers(vectors, id_col, vector_col)
    distinct = stage_table(rows.select("x").distinct(), "whitening-fit")
    if dim is None:
        top = distinct.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
        dim = top[0]["dim"] if top else 1
    sized = distinct.where(F.size("x") == dim)
    model = fit(sized, dim, components, fan, block_rows)
    schema = T.StructType([T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    if model is None or not len(model.variances):
        return rows.sparkSession.createDataFrame([], schema)
    error, k = identity_error(sized, dim, model), len(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            columns = [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                       pa.array(model.deviations(x), pa.int64()).take(each), pa.array(model.whiten(x).ravel()),
                       pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return rows.where(F.size("x") == dim).mapInArrow(run, schema)
