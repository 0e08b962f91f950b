"""Embedding whitening with a covariance by polarisation.

Entries become integers y = floor(scale * entry); the fit list is each distinct
vector of them once. For every dimension and every sum of two dimensions the
squares of the centred values are added up as exact integers, and the
covariances follow from differences of variances:
cov(a, b) = (var(a + b) - var(a) - var(b)) / 2. The matrix goes to ``eigh``;
whitened values are the centred vectors projected on its unit eigenvectors, over
the square root of the eigenvalues.

Centring is exact too: values are taken less the rounded mean m, and what the
rounding leaves is put right with integers (a variance times n is the sum of
squares of y - m, less (sum of y - m)^2 / n).

Per task one row for each dimension, or pair of dimensions, is sent on, however
many vectors there are; the driver gets sums only, and its matrix is bounded by
the dimension. Equal vectors are counted before the shuffle, so a vector of any
frequency costs one row per task.

Left out: null vectors, empty ones, those with a null or non-finite entry or one
of 2^39 or more (scaled, the sums of their squares might not fit 38 digits), and
those of another length than the most frequent one (ties: the longer). Repeated
rows and null keys stay as rows. Directions without variance (eigenvalue within
rounding of 0) have no component; if there is none, or no row, the result is
empty. ``deviation`` is null where its value needs more than 64 bits; columns
beside key and vector are ignored.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .tables import stored

SCALE = 64
COMPONENTS = 16
#: Largest magnitude of a scaled entry.
LIMIT = 2.0 ** 45
#: Vectors whose squares are added at a time.
ROWS = 1024
DIGITS = pa.decimal128(38, 0)


def entries(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows hold a usable vector, their lengths, and all their scaled entries."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    values = pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(values * scale)
        bad = ~(np.abs(scaled) < LIMIT)
    row = np.repeat(np.arange(len(lengths)), lengths)
    good = (lengths > 0) & (np.bincount(row[bad], minlength=len(lengths)) == 0)
    return good, lengths[good], scaled[good[row]].astype("<i8")


def _quantised(batches: Iterable[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good, lengths, flat = entries(batch.column(0), scale)
        at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64) * 8
        x = pa.Array.from_buffers(pa.large_binary(), len(lengths), [
            None, pa.py_buffer(at.tobytes()), pa.py_buffer(flat.tobytes())])
        yield pa.record_batch({"x": x.cast(pa.binary())})


def fit_list(df: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """Distinct scaled vectors as bytes ``x``, and the number of their ``rows``."""
    x = df.select(vector).mapInArrow(lambda b: _quantised(b, scale), "x binary")
    return x.groupBy("x").agg(F.count(F.lit(1)).alias("rows"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dim)


def _digits(values: Iterable[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], DIGITS)


def _sums(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    n, total = 0, [0] * dim
    for batch in batches:
        y = _matrix(batch.column(0), dim)
        high, low = (y >> 24).sum(0).tolist(), (y & 0xFFFFFF).sum(0).tolist()
        total = [t + (h << 24) + v for t, h, v in zip(total, high, low)]
        n += len(y)
    yield pa.record_batch({"i": pa.array(range(dim), pa.int32()),
                           "n": pa.array([n] * dim, pa.int64()), "total": _digits(total)})


def square_sums(p: np.ndarray) -> list[int]:
    """Exact sums of squares along the rows of ``p`` (at most 2^20 columns)."""
    if p.size == 0 or int(np.abs(p).max()) < 2 ** 26 and p.shape[1] <= ROWS:
        return np.einsum("ij,ij->i", p, p).tolist()
    # Three limbs of 21 bits; each sum of products stays below 2^63.
    a, b, c = p >> 42, (p >> 21) & 0x1FFFFF, p & 0x1FFFFF

    def dot(x, y):
        return np.einsum("ij,ij->i", x, y).tolist()

    return [(aa << 84) + (ab << 64) + ((2 * ac + bb) << 42) + (bc << 22) + cc
            for aa, ab, ac, bb, bc, cc in zip(dot(a, a), dot(a, b), dot(a, c), dot(b, b),
                                              dot(b, c), dot(c, c))]


def _squares(batches: Iterable[pa.RecordBatch], middle: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each dimension (j null) and each sum of two, the squares of this task's vectors."""
    dim = len(middle)
    single, pairs = [0] * dim, [[0] * (dim - i - 1) for i in range(dim)]
    for batch in batches:
        y = _matrix(batch.column(0), dim)
        for start in range(0, len(y), ROWS):
            z = np.ascontiguousarray((y[start:start + ROWS] - middle).T)
            single = [t + v for t, v in zip(single, square_sums(z))]
            for i in range(dim - 1):
                pairs[i] = [t + v for t, v in zip(pairs[i], square_sums(z[i + 1:] + z[i]))]
    yield pa.record_batch({"i": pa.array(range(dim), pa.int32()),
                           "j": pa.nulls(dim, pa.int32()), "squares": _digits(single)})
    for i in range(dim - 1):
        yield pa.record_batch({"i": pa.array([i] * (dim - i - 1), pa.int32()),
                               "j": pa.array(range(i + 1, dim), pa.int32()),
                               "squares": _digits(pairs[i])})


@dataclass(frozen=True)
class Model:
    n: int                    # vectors of the fit list
    middle: np.ndarray        # integer near the mean, per dimension
    rest: list[int]           # sums less n times that
    directions: np.ndarray    # dimensions x components, unit vectors
    eigenvalues: np.ndarray
    explained: np.ndarray
    scale: int = SCALE

    def whiten(self, y: np.ndarray) -> np.ndarray:
        centred = (y - self.middle) - np.array([r / self.n for r in self.rest])
        return centred @ self.directions / np.sqrt(self.eigenvalues)

    def deviations(self, y: np.ndarray) -> list[int]:
        """Per vector the sum of (n * x - S)^2 over the dimensions, exact."""
        z, n = y - self.middle, self.n
        most = int(np.abs(z).max(initial=0))
        rest = np.array(self.rest, dtype=object)
        if most * max([most, *map(abs, self.rest)]) * len(rest) < 2 ** 62:
            rest = rest.astype(np.int64)
        else:
            z = z.astype(object)
        squares, mixed = (z * z).sum(1).tolist(), (z * rest).sum(1).tolist()
        last = sum(r * r for r in self.rest)
        return [n * n * s - 2 * n * m + last for s, m in zip(squares, mixed)]


def covariance(n: int, rest: list[int], single: list[int],
               pairs: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix from the sums of squares of dimensions and of pair sums."""
    dim = len(rest)

    def spread(squares, total):  # n times n times the variance
        return n * squares - total * total

    own = [spread(q, s) for q, s in zip(single, rest)]
    v = np.empty((dim, dim))
    for i in range(dim):
        v[i, i] = own[i] / (n * n)
        for j in range(i + 1, dim):
            both = spread(pairs[i, j], rest[i] + rest[j])
            v[i, j] = v[j, i] = (both - own[i] - own[j]) / (2 * n * n)
    return v


def fit(listed: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> Model | None:
    """The model of a fit list (stored by the caller), None without any variance."""
    row = (listed.groupBy((F.octet_length("x") / 8).cast("int").alias("dim"))
           .agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), F.desc("dim")).first())
    if row is None:
        return None
    dim = row["dim"]
    x = of_length(listed, dim)
    sums = (x.mapInArrow(lambda b: _sums(b, dim), "i int, n long, total decimal(38,0)")
            .groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
            .orderBy("i").collect())
    n, total = sums[0]["n"], [int(r["total"]) for r in sums]
    middle = [(2 * t + n) // (2 * n) for t in total]
    rest = [t - n * m for t, m in zip(total, middle)]
    at = np.array(middle, dtype=np.int64)
    squares = (x.mapInArrow(lambda b: _squares(b, at), "i int, j int, squares decimal(38,0)")
               .groupBy("i", "j").agg(F.sum("squares").alias("squares")).collect())
    of = {(r["i"], r["j"]): int(r["squares"]) for r in squares}
    v = covariance(n, rest, [of[i, None] for i in range(dim)], of)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > dim * np.finfo(float).eps * max(values.max(), 0.0)]
    order = order[:components]
    if not len(order):
        return None
    vectors = vectors[:, order]
    largest = vectors[np.abs(vectors).argmax(0), np.arange(len(order))]
    return Model(n, at, rest, vectors * np.sign(largest), values[order],
                 values[order] / np.trace(v), scale)


def of_length(listed: DataFrame, dim: int) -> DataFrame:
    return listed.filter(F.octet_length("x") == 8 * dim).select("x")


def _moments(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    k = len(model.eigenvalues)
    total, products = np.zeros(k), np.zeros((k, k))
    for batch in batches:
        w = model.whiten(_matrix(batch.column(0), len(model.middle)))
        total += w.sum(0)
        products += w.T @ w
    a, b = np.divmod(np.arange(k * k), k)
    yield pa.record_batch({"a": pa.array(np.concatenate([a, np.arange(k)]), pa.int32()),
                           "b": pa.array([*b.tolist(), *[None] * k], pa.int32()),
                           "total": pa.array(np.concatenate([products.ravel(), total]))})


def identity_error(listed: DataFrame, model: Model) -> float:
    """Largest entry of the whitened fit list's covariance less the identity, as it
    is measured on its vectors, to 15 decimals."""
    k = len(model.eigenvalues)
    rows = (of_length(listed, len(model.middle))
            .mapInArrow(lambda b: _moments(b, model), "a int, b int, total double")
            .groupBy("a", "b").agg(F.sum("total").alias("total")).collect())
    of = {(r["a"], r["b"]): r["total"] / model.n for r in rows}
    return round(max(abs(of[a, b] - of[a, None] * of[b, None] - (a == b))
                     for a in range(k) for b in range(k)), 15)


def _whitened(batches: Iterable[pa.RecordBatch], model: Model, key: str,
              error: float) -> Iterator[pa.RecordBatch]:
    dim, k = len(model.middle), len(model.eigenvalues)
    for batch in batches:
        good, lengths, flat = entries(batch.column(1), model.scale)
        fits = lengths == dim
        y = flat[np.repeat(fits, lengths)].reshape(-1, dim)
        rows = np.repeat(np.flatnonzero(good)[fits], k)
        exact = [d if d < 2 ** 63 else None for d in model.deviations(y)]
        yield pa.record_batch({
            key: batch.column(0).take(pa.array(rows)),
            "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
            "n": pa.array(np.full(len(rows), model.n)),
            "deviation": pa.array(exact, pa.int64()).take(pa.array(np.repeat(
                np.arange(len(y)), k))),
            "whitened": pa.array(model.whiten(y).ravel()),
            "explained": pa.array(np.tile(model.explained, len(y))),
            "identity_error": pa.array(np.full(len(rows), error))})


def whitened(df: DataFrame, key: str, vector: str, components: int = COMPONENTS,
             scale: int = SCALE) -> DataFrame:
    """One row per usable vector and component, with the figures of the fit.

    ``df`` is read twice: for the fit list, which is stored, and to be whitened.
    """
    schema = StructType([df.select(key).schema[0], *StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, "
        "identity_error double")])
    if key in schema.names[1:]:
        raise ValueError(f"{key} is the name of a result column")
    schema = StructType([StructField(f.name, f.dataType, True) for f in schema])
    listed, _ = stored(fit_list(df, vector, scale), "fit-list")
    model = fit(listed, components, scale)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(listed, model)
    return df.select(key, vector).mapInArrow(
        lambda b: _whitened(b, model, key, error), schema)
