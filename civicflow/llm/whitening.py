"""Operator 12: whitening of embeddings by their leading principal components.

1. Rows whose vector is null or holds null or non-finite entries go.  Each
   entry c becomes the integer ``floor(SCALE * c)``; the integers of a vector
   are packed in the narrowest width that holds them, so equal vectors are
   equal bytes.  The *fit list* is each distinct vector once (a partial and a
   final aggregate; copies of a hot vector meet as one row per task).
2. Two passes over the fit list: exact sums S and the count n, then the covariance of
   the centred entries ``(n*x - S) / n``.  Tasks sum their rows to one matrix, Spark adds
   the entries of the tasks' matrices; d * (d + 1) / 2 numbers reach the driver.
3. The driver reduces the d x d matrix by Householder reflections to a tridiagonal
   one, brackets its leading eigenvalues by Sturm counts and bisection, and
   finds the vectors by inverse iteration, orthogonalised inside clusters of close values.
4. Mean, components and eigenvalues are broadcast (a few d numbers) and all rows projected.

The work on the driver depends on the dimension alone, never on the rows.

Edge cases: the space has the dimension that most distinct vectors have (ties:
the larger one), vectors of another length and empty ones go; repeated rows
are returned each, also those with a null ``vec_id``; entries beyond 2**53 / SCALE
count as that bound; a component without variance (eigenvalue below d * 2**-52
of the trace) has ``whitened`` and ``explained`` 0 and stands outside ``identity_error``,
which is 0 if no component has variance; ``deviation`` is null where it exceeds a long; an
empty table, or one that loses all rows, gives no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import prepare, staged

SCALE = 256
COMPONENTS = 4
#: Bound of an entry's integer.
LIMIT = 1 << 53
#: Digits that exact sums carry apart, so that no task's sum of them overflows.
_LOW = 26

OUT_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")


# -- vectors of integers ------------------------------------------------------

def quantised(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that stay, and their integer vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64())
    value = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(value))])
    keep = np.flatnonzero((size > 0) & (bad[ends] == bad[ends - size]))
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.clip(np.floor(value * SCALE), -LIMIT, LIMIT)
    return keep, [x[ends[i] - size[i]:ends[i]].astype(np.int64) for i in keep.tolist()]


def pack(x: np.ndarray) -> bytes:
    """A width byte and the integers in the narrowest signed type."""
    for width in (1, 2, 4):
        info = np.iinfo(f"i{width}")
        if info.min <= x.min() and x.max() <= info.max:
            break
    else:
        width = 8
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def unpack(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, f"<i{payload[0]}", offset=1).astype(np.int64)


def _packed(column: str, batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        keep, vectors = quantised(batch.column(batch.schema.get_field_index(column)))
        ids = batch.column(batch.schema.get_field_index("vec_id")).take(pa.array(keep))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(v) for v in vectors], pa.int32()),
             pa.array([pack(v) for v in vectors], pa.binary())], ["vec_id", "d", "x"])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([unpack(p) for p in batch.column(batch.schema.get_field_index("x")).to_pylist()])


# -- distributed moments ------------------------------------------------------

def _sums(d: int, batches: Iterator[pa.RecordBatch]):
    n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch)
            n += len(x)
            high += (x >> _LOW).sum(0)
            low += (x & ((1 << _LOW) - 1)).sum(0)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)), pa.array(high),
             pa.array(low)], ["i", "n", "high", "low"])


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""
    rows = (fit.mapInArrow(lambda it: _sums(d, it), "i int, n long, high long, low long")
            .groupBy("i").agg(F.sum("n").alias("n"),
                              F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
                              F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect())
    total = [0] * d
    for r in rows:
        total[r["i"]] = (int(r["high"]) << _LOW) + int(r["low"])
    return (int(rows[0]["n"]) if rows else 0), total


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n as doubles: the integer part of S/n goes exactly, the rest is below 1."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def _products(n: int, sums: list[int], batches: Iterator[pa.RecordBatch]):
    d = len(sums)
    total = np.zeros((d, d))
    rows = 0
    for batch in batches:
        if batch.num_rows:
            y = centred(_matrix(batch), n, sums)
            total += y.T @ y
            rows += len(y)
    if rows:
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
            ["i", "j", "v"])


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the fit list, divisor n, centred before multiplying."""
    rows = (fit.mapInArrow(lambda it: _products(n, sums, it), "i int, j int, v double")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    out = np.zeros((len(sums), len(sums)))
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"] / n
    return out


# -- symmetric eigenproblem ---------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and Q with ``a = Q T Q'``, by Householder reflections."""
    a, d = np.array(a, np.float64), len(a)
    q = np.eye(d)
    for k in range(d - 2):
        v = a[k + 1:, k].copy()
        if not np.abs(v[1:]).max(initial=0.0):
            continue
        # Scaled, so that squares of very small or large entries keep their digits.
        v /= np.abs(v).max()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        a[k + 1:, :] -= 2 * np.outer(v, v @ a[k + 1:, :])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ v, v)
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def sturm_count(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Eigenvalues below each x: the negative pivots of T - x."""
    squares = np.concatenate([[0.0], off * off])
    tiny = np.finfo(float).tiny * max(1.0, squares.max(initial=0.0)) / np.finfo(float).eps
    pivot = np.ones_like(x)
    below = np.zeros(len(x), np.int64)
    for d, s in zip(diagonal, squares):
        pivot = d - x - s / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection of Sturm counts down to the last bit."""
    d = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    pad = 2 * np.finfo(float).eps * max(abs(low[0]), abs(high[0])) + np.finfo(float).tiny
    low, high = low - pad, high + pad
    wanted = d - 1 - np.arange(k)       # so many eigenvalues lie below the one sought
    for _ in range(128):
        mid = low + (high - low) / 2
        up = sturm_count(diagonal, off, mid) <= wanted
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Solution of the tridiagonal system, by elimination with row exchanges."""
    n = len(b)
    b, a = b.copy(), diagonal.copy()
    up, up2, down = np.append(off, 0.0), np.zeros(n), np.append(off, 0.0)
    for i in range(n - 1):
        if abs(down[i]) > abs(a[i]):
            factor = a[i] / down[i]
            a[i], up[i], up2[i], a[i + 1], up[i + 1], b[i], b[i + 1] = (
                down[i], a[i + 1], up[i + 1], up[i] - factor * a[i + 1], -factor * up[i + 1],
                b[i + 1], b[i] - factor * b[i + 1])
        else:
            a[i] = a[i] if abs(a[i]) > least else least
            factor = down[i] / a[i]
            a[i + 1] -= factor * up[i]
            b[i + 1] -= factor * b[i]
    a[n - 1] = a[n - 1] if abs(a[n - 1]) > least else least
    x = np.zeros(n + 2)
    for i in range(n - 1, -1, -1):
        x[i] = (b[i] - up[i] * x[i + 1] - up2[i] * x[i + 2]) / a[i]
        if abs(x[i]) > 1e150:
            x, b = x * 1e-150, b * 1e-150
    return x[:n]


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of the values, by inverse iteration.

    Values closer than a thousandth of the norm form a cluster: each iterate
    is made orthogonal to the cluster's earlier vectors."""
    d = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    rng = np.random.default_rng(12)
    out, cluster, shift = [], [], None
    for k, value in enumerate(values):
        near = k and values[k - 1] - value <= 1e-3 * norm
        cluster = cluster + [out[-1]] if near else []
        # Equal values are set apart by a few last bits, so that their systems differ.
        step = 4 * np.finfo(float).eps * norm
        shift = min(value, shift - step) if near else value
        v = rng.standard_normal(d)
        v /= np.linalg.norm(v)
        for _ in range(6):
            v = _solve(diagonal - shift, off, v, np.finfo(float).eps * norm)
            v /= np.abs(v).max()
            for _ in range(2):
                for u in cluster:
                    v = v - (u @ v) * u
            v /= np.linalg.norm(v)
        out.append(v)
    return np.array(out).reshape(len(values), d)


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix and their unit vectors (rows)."""
    k = min(k, len(v))
    scale = np.abs(v).max(initial=0.0)
    if not scale:
        return np.zeros(k), np.eye(len(v))[:k]
    diagonal, off, q = tridiagonal(v / scale)
    values = leading_values(diagonal, off, k)
    vectors = tridiagonal_vectors(diagonal, off, values) @ q.T
    # The sign is fixed so that repeated fits agree: the largest entry is positive.
    sign = np.sign(vectors[np.arange(k), np.abs(vectors).argmax(1)])
    return values * scale, vectors * sign[:, None]


# -- projection ---------------------------------------------------------------

class Whitening:
    """A fit: n, S, eigenvalues, components and the trace; small enough to broadcast."""

    def __init__(self, n: int, sums: list[int], v: np.ndarray, k: int):
        self.n, self.sums = n, sums
        self.values, self.vectors = leading_components(v, k)
        self.trace = float(np.trace(v))
        self.real = self.values > len(v) * np.finfo(float).eps * self.trace
        root = np.sqrt(np.where(self.real, self.values, 1.0))
        self.scaled = np.where(self.real[:, None], self.vectors / root[:, None], 0.0)

    @property
    def explained(self) -> np.ndarray:
        return np.where(self.real, self.values / (self.trace or 1.0), 0.0)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates (rows, components) of integer vectors."""
        return centred(x, self.n, self.sums) @ self.scaled.T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)**2, exact; None beyond a long."""
        about = (centred(x, self.n, self.sums) ** 2).sum(1) * float(self.n) ** 2
        out: list = [None] * len(x)
        fits = np.flatnonzero(about < 2.0 ** 62)
        # A sum below 2**62 has no difference beyond 2**31: products wrap in no step that counts.
        with np.errstate(over="ignore"):
            low = np.array([(s + 2 ** 63) % 2 ** 64 - 2 ** 63 for s in self.sums], np.int64)
            exact = ((x[fits] * np.int64(self.n) - low) ** 2).sum(1)
        for i, v in zip(fits.tolist(), exact.tolist()):
            out[i] = v
        for i in np.flatnonzero((about >= 2.0 ** 62) & (about < 2.0 ** 63 * 1.001)).tolist():
            v = sum((self.n * a - s) ** 2 for a, s in zip(x[i].tolist(), self.sums))
            out[i] = v if v < 1 << 63 else None
        return out


def _moments(fit, batches: Iterator[pa.RecordBatch]):
    """Count, mean and centred products of the whitened rows of a task."""
    parts = []
    for batch in batches:
        if batch.num_rows:
            w = fit.value.project(_matrix(batch))
            m = w.mean(0)
            parts.append((len(w), m, (w - m).T @ (w - m)))
    if parts:
        n, m, p = merge_moments(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([m.tolist()], pa.list_(pa.float64())),
             pa.array([p.ravel().tolist()], pa.list_(pa.float64()))], ["n", "mean", "products"])


def merge_moments(parts) -> tuple[int, np.ndarray, np.ndarray]:
    """Moments of a union from those of its parts."""
    n, m, p = parts[0]
    for k, mean, products in parts[1:]:
        gap = mean - m
        p = p + products + np.outer(gap, gap) * (n * k / (n + k))
        m = m + gap * (k / (n + k))
        n += k
    return n, m, p


def identity_error(fit: DataFrame, model) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity.

    The moments of the tasks meet in groups first, so the driver gets few rows."""
    schema = "n long, mean array<double>, products array<double>"

    def joined(rows):
        import pandas as pd
        k = len(rows["mean"].iloc[0])
        parts = [(r.n, np.array(r.mean_), np.array(r.products).reshape(k, k))
                 for r in rows.rename(columns={"mean": "mean_"}).itertuples()]
        n, m, p = merge_moments(parts)
        return pd.DataFrame({"n": [n], "mean": [m.tolist()], "products": [p.ravel().tolist()]})

    rows = (fit.mapInArrow(lambda it: _moments(model, it), schema)
            .groupBy(F.pmod(F.xxhash64("mean"), F.lit(64)).alias("g"))
            .applyInPandas(joined, schema).collect())
    k = len(model.value.values)
    parts = [(r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(k, k)) for r in rows]
    n, _, p = merge_moments(parts)
    real = model.value.real
    gap = np.abs(p / n - np.eye(k))[np.ix_(real, real)]
    return float(gap.max(initial=0.0))


def _projected(model, error: float, batches: Iterator[pa.RecordBatch]):
    fit = model.value
    k = len(fit.values)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch)
        rows = np.repeat(np.arange(len(x)), k)
        dev = pa.array(fit.deviations(x), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows)),
             pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
             pa.array(np.full(len(rows), fit.n)), dev.take(pa.array(rows)),
             pa.array(fit.project(x).ravel()), pa.array(np.tile(fit.explained, len(x))),
             pa.array(np.full(len(rows), error))],
            ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whitened(table: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every usable row of ``table`` (vec_id, ``column``)."""
    spark = prepare(table.sparkSession)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"),
                        F.col(column).alias(column)).mapInArrow(
        lambda it: _packed(column, it), "vec_id long, d int, x binary")
    fit = staged(rows.select("d", "x").distinct(), "vectors")
    top = fit.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if top is None:
        return spark.createDataFrame([], OUT_SCHEMA)
    d = top["d"]
    fit = fit.where(F.col("d") == d)
    n, sums = exact_sums(fit, d)
    model = spark.sparkContext.broadcast(Whitening(n, sums, covariance(fit, n, sums), components))
    error = identity_error(fit, model)
    return rows.where(F.col("d") == d).mapInArrow(
        lambda it: _projected(model, error, it), OUT_SCHEMA)
