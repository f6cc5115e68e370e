"""Whitening of embeddings: covariances from variances alone, by polarisation.

Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b).  So one pass sums the exact squares of every centred dimension and of the sum of every pair of
centred dimensions, and differences of these sums give every cross-covariance; no product of two dimensions is formed.
Vectors are whole numbers (x = floor(1024 * c) + 100000), centred at the whole number m next to the mean; with y = x - m, R = S - n * m the
identity  sum((n * x - S) ** 2) = n * n * sum(y ** 2) - n * R * R  holds in whole numbers, so V is exact until it is rounded once for the eigenvectors.

A task holds one batch of vectors and d * (d + 1) / 2 sums; it hands on one row of sums for each pair, in three limbs of 40 bits, so
that no number of rows overflows; tasks' rows are added by pair.  The driver gets d * (d + 1) / 2 rows, which grow with the dimension and
not with the number of vectors, and the components are sent to the tasks (8 * d numbers).

Defined results: vectors that are null, empty or hold null, NaN or infinite entries are dropped, and so are vectors whose length is not the most frequent one
(ties: the longer), which lie in another space; repeated rows count as often as they stand there; ids may be null or repeated.
An entry beyond the whole numbers of 64 bits is held at their end; a deviation beyond them is null.  A component
without variance (fewer different vectors than components) has null as whitened value and does not count in identity_error; with no variance at all explained is null too.
Of equal eigenvalues any orthonormal vectors are taken.  The entry of largest size of each component is positive.
No vectors give no rows.  Columns of the table stay, whatever their names; one named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LIMB = 40
#: Whole numbers up to here may be added and multiplied by 2 in 64 bits without a look.
SAFE = 1 << 62
HELPER = "__nw"


@dataclass(frozen=True)
class Whitening:
    """What a fit on all vectors gives: n vectors of x-sums S, components (rows) with their eigenvalues, trace of V."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    #: whether a component has variance
    live: np.ndarray

    @property
    def explained(self) -> np.ndarray | None:
        return self.eigenvalues / self.trace if self.trace > 0 else None


def _vectors(batch: pa.RecordBatch, column: str, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of usable vectors in the batch and their x as rows of whole numbers; without dim only the places, and their lengths."""
    vec = batch.column(batch.schema.get_field_index(column))
    sizes = vec.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vec.flatten().cast(pa.float64())
    entry = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(entry))))
    usable = (sizes > 0) & (bad[ends] == bad[ends - sizes])
    if dim is None:
        at = np.flatnonzero(usable)
        return at, sizes[at]
    at = np.flatnonzero(usable & (sizes == dim))
    rows = entry[(ends - sizes)[at][:, None] + np.arange(dim)]
    with np.errstate(over="ignore"):
        x = np.floor(rows * SCALE)
    return at, x.astype(np.int64) + SHIFT if np.abs(x).max(initial=0) < SAFE else _wide(x)


def _wide(x: np.ndarray) -> np.ndarray:
    """Entries of any size as Python's whole numbers, within 64 bits."""
    end = 1 << 63
    return np.array([[min(int(min(max(v, -float(end)), float(end))) + SHIFT, end - 1) for v in row] for row in x], dtype=object).reshape(x.shape)


def _fits(rows: int, most: int) -> bool:
    return rows * most * most < SAFE


def _centred(x: np.ndarray, middle: list[int]) -> tuple[np.ndarray, int]:
    """x - middle, and its largest size; in 64 bits where that fits."""
    if x.dtype == object or max(map(abs, middle)) >= SAFE:
        y = x.astype(object) - np.array(middle, dtype=object)
        most = max((abs(v) for row in y for v in row), default=0)
        return (y.astype(np.int64), most) if most < SAFE else (y, most)
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    if max(abs(low), abs(high)) + max(map(abs, middle)) >= SAFE:
        return _centred(x.astype(object), middle)
    y = x - np.array(middle, np.int64)
    return y, int(np.abs(y).max(initial=0))


def _limbs(values: list[int]) -> list[pa.Array]:
    mask = (1 << LIMB) - 1
    return [pa.array([v & mask for v in values], pa.int64()), pa.array([v >> LIMB & mask for v in values], pa.int64()), pa.array([v >> 2 * LIMB for v in values], pa.int64())]


def _whole(row) -> int:
    return row.lo + (row.mid << LIMB) + (row.hi << 2 * LIMB)


def _summed(df: DataFrame, step, key: str) -> dict[int, int]:
    """Exact sums by key over all tasks."""
    parts = df.mapInArrow(step, f"{key} int, lo bigint, mid bigint, hi bigint")
    return {r[key]: _whole(r) for r in parts.groupBy(key).agg(*(F.sum(c).alias(c) for c in ("lo", "mid", "hi"))).collect()}


def _sums(column: str, dim: int):
    """Number of vectors (under dim) and the sum of each dimension, of one task."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dim + 1)
        for b in batches:
            at, x = _vectors(b, column, dim)
            if not len(at):
                continue
            wide = x.dtype != object and int(np.abs(x).max()) * len(at) >= SAFE
            total = [t + int(v) for t, v in zip(total, [*(x.astype(object) if wide else x).sum(axis=0), len(at)], strict=True)]
        if total[dim]:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()), *_limbs(total)], ["d", "lo", "mid", "hi"])

    return step


def _squares(column: str, middle: list[int]):
    """Sums of the squares of y_i (key i, i) and of y_i + y_j (key i, j), of one task; keys are numbered row by row of the upper triangle."""
    dim = len(middle)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = [0] * (dim * (dim + 1) // 2), False
        for b in batches:
            at, x = _vectors(b, column, dim)
            if not len(at):
                continue
            seen = True
            y, most = _centred(x, middle)
            if y.dtype != object and not _fits(len(y), 2 * most):
                y = y.astype(object)
            y, found = np.asfortranarray(y), []
            for i in range(dim):
                pair = y[:, i:] + y[:, i : i + 1]
                pair[:, 0] = y[:, i]
                found.extend(np.einsum("ij,ij->j", pair, pair) if y.dtype != object else (pair * pair).sum(axis=0))
            total = [t + int(v) for t, v in zip(total, found, strict=True)]
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), *_limbs(total)], ["d", "lo", "mid", "hi"])

    return step


def _lengths(column: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[int, int] = {}
        for b in batches:
            for size, n in zip(*np.unique(_vectors(b, column)[1], return_counts=True), strict=True):
                count[int(size)] = count.get(int(size), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.int32()), pa.array(count.values(), pa.int64())], ["size", "n"])

    return step


def dimension(df: DataFrame, column: str) -> int | None:
    """The most frequent length of usable vectors (ties: the longer)."""
    sizes = df.select(column).mapInArrow(_lengths(column), "size int, n bigint").groupBy("size").agg(F.sum("n").alias("n"))
    top = sizes.orderBy(F.col("n").desc(), F.col("size").desc()).first()
    return top["size"] if top else None


def covariance(df: DataFrame, column: str) -> tuple[int, list[int], list[list[int]]] | None:
    """n, S and the exact n ** 3 * V (sums of (n * x_i - S_i) * (n * x_j - S_j)), recovered from squares alone; None without vectors."""
    dim = dimension(df, column)
    if dim is None:
        return None
    vectors = df.select(column)
    sums = _summed(vectors, _sums(column, dim), "d")
    n, total = sums[dim], [sums[i] for i in range(dim)]
    middle = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * m for s, m in zip(total, middle, strict=True)]
    squares = _summed(vectors, _squares(column, middle), "d")
    at = [i * dim - i * (i - 1) // 2 for i in range(dim)]  # place of (i, i)
    own = [n * n * squares[at[i]] - n * rest[i] ** 2 for i in range(dim)]
    out = [[0] * dim for _ in range(dim)]
    for i in range(dim):
        out[i][i] = own[i]
        for j in range(i + 1, dim):
            both = n * n * squares[at[i] + j - i] - n * (rest[i] + rest[j]) ** 2
            out[i][j] = out[j][i] = (both - own[i] - own[j]) // 2
    return n, total, out


def fit(df: DataFrame, column: str, components: int = COMPONENTS) -> Whitening | None:
    found = covariance(df, column)
    if found is None:
        return None
    n, total, cov = found
    v = np.array([[c / n**3 for c in row] for row in cov])  # each is rounded once
    values, vectors = np.linalg.eigh(v)
    k = min(components, len(total))
    values, vectors = values[::-1][:k], vectors.T[::-1][:k]
    vectors = vectors * np.where(vectors[np.arange(k), np.abs(vectors).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
    return Whitening(n, tuple(total), vectors, values, sum(cov[i][i] for i in range(len(total))) / n**3, values > max(values[0], 0) * len(total) * np.finfo(float).eps * 4)


def _project(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, list]:
    """Whitened values (NaN without variance) and exact deviations of the rows of x."""
    n, dim = model.n, len(model.sums)
    middle = [(2 * s + n) // (2 * n) for s in model.sums]
    rest = [s - n * m for s, m in zip(model.sums, middle, strict=True)]
    y, most = _centred(x, middle)
    centred = y.astype(np.float64) - np.array([r / n for r in rest])
    scale = np.where(model.live, np.sqrt(np.where(model.live, model.eigenvalues, 1.0)), np.nan)
    white = centred @ model.components.T / scale
    if y.dtype != object and dim * (n * (most + 1)) ** 2 < SAFE:
        off = y * np.int64(n) - np.array(rest, np.int64)
        return white, np.einsum("ij,ij->i", off, off).tolist()
    off = y.astype(object) * n - np.array(rest, dtype=object)
    return white, [v if v < 1 << 63 else None for v in (off * off).sum(axis=1).tolist()]


def _identity_error(vectors: DataFrame, model: Whitening, column: str) -> float | None:
    """Largest absolute entry of the covariance of the whitened values, taken from the values themselves, minus the identity."""
    live = np.flatnonzero(model.live)
    k, dim = len(live), len(model.sums)
    if not k:
        return None

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            at, x = _vectors(b, column, dim)
            if len(at):
                white = _project(model, x)[0][:, live]
                first, second = first + white.sum(axis=0), second + white.T @ white
        yield pa.RecordBatch.from_arrays([pa.array(range(k + k * k), pa.int32()), pa.array(np.concatenate((first, second.ravel())))], ["d", "v"])

    rows = vectors.mapInArrow(step, "d int, v double").groupBy("d").agg(F.sum("v").alias("v")).collect()
    got = np.array([r.v for r in sorted(rows)]) / model.n
    return float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening, column: str, to: str = "whitening") -> DataFrame:
    """The rows with usable vectors, with a struct column `to` of deviation and whitened values (a list, by component)."""
    dim = len(model.sums)
    kind = pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = _vectors(b, HELPER, dim)
            if not len(at):
                continue
            white, deviation = _project(model, x)
            flat = pa.array(white.ravel(), from_pandas=True)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * white.shape[1], pa.int32()), flat)
            found = pa.StructArray.from_arrays([pa.array(deviation, pa.int64()), lists], fields=list(kind))
            kept = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*kept.columns[:-1], found], [*b.schema.names[:-1], to])

    others = df.drop(to) if to != column else df.drop(column)
    rows = others.withColumn(HELPER, df[column])
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in others.schema)
    return rows.mapInArrow(step, f"{schema}{', ' if schema else ''}`{to}` struct<deviation: bigint, whitened: array<double>>")


def op11(embeddings: DataFrame) -> DataFrame:
    model = fit(embeddings, "embedding")
    empty = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None:
        return embeddings.sparkSession.createDataFrame([], empty)
    error = _identity_error(embeddings.select("embedding"), model, "embedding")
    share = model.explained
    shares = F.lit([float(s) for s in share]) if share is not None else F.lit(None).cast("array<double>")
    rows = whiten(embeddings.select("vec_id", "embedding"), model, "embedding").select("vec_id", "whitening.deviation", F.posexplode("whitening.whitened").alias("k", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("k")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
