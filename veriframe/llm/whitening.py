"""Whitening of embeddings: principal components by a pivoted Cholesky factor and one-sided Jacobi rotations.

Vectors are put on an integer grid, x = floor(``SCALE`` * c) + ``OFFSET``, and each distinct x is fitted once.

1. The distinct x are written once (partial aggregation, so a vector with very many copies costs nothing more); their number n
   and sums S are exact integers.
2. Each task adds up the scatter of its rows, centred before multiplying: (n * x - S) / n is exact up to one rounding. A task gives
   d rows of the d x d matrix, whatever it has read; these are summed by row number.
3. On the driver, where the d x d matrix is all that is held: V = L L' with the largest remaining diagonal entry as pivot, then
   rotations of pairs of L's columns until all are orthogonal. Squared column norms are the eigenvalues, columns divided by their
   norms the eigenvectors. V's columns are never multiplied again, so small eigenvalues keep their relative precision.
4. A second pass over the distinct x measures how far the covariance of the whitened vectors is from the identity.

The driver's part depends on the dimension alone: three d x d matrices of doubles (25 MB at d = 1,024).

Defined cases: rows whose vector is null, empty, or holds a null or non-finite entry are left out, and so are rows of another length
than most distinct vectors have (of equally frequent lengths the greater counts). No rows, or no two different vectors, give no
components and so no rows; components beyond the rank of V don't exist. Entries beyond 2 ** 62 on the grid are put at its
ends. A deviation that doesn't fit in a long is null. Repeated rows each have their rows; ids may be of any type, or null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.common import saved, shuffle_partitions, table

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: The grid ends here.
LARGEST = 1 << 62
#: Numbers that a task holds at once, besides its matrix.
ENTRIES = 1 << 20


@dataclass(frozen=True)
class Whitening:
    """n, sums: of the fitted vectors. components: d x k, unit columns by falling value. trace: of V."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float


def grid(vector: Column) -> Column:
    """The vector's x, or null if it can't be used."""
    entries = vector.cast("array<double>")
    good = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(good & (F.size(entries) > 0), F.transform(entries, lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(c * SCALE).cast("long"))) + OFFSET))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def parts(column: pa.Array, width: int) -> Iterator[pa.Array]:
    step = max(1, ENTRIES // width)
    for at in range(0, len(column), step):
        yield column.slice(at, step)


def from_sums(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S, exact: as longs where they suffice, else as Python's integers."""
    if int(np.abs(x.astype(np.float64)).max(initial=0)) * n + max(map(abs, sums)) < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(off: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows of n * x - S."""
    if off.dtype != object and off.shape[1] * int(np.abs(off).max(initial=0)) ** 2 < 1 << 63:
        return (off * off).sum(axis=1).tolist()
    return [s if (s := sum(int(c) ** 2 for c in row)) < 1 << 63 else None for row in off]


def exact_sums(fitted: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    """The number of vectors and their exact sums: tasks add the upper and the lower 32 bits apart, so that nothing overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            for part in parts(batch.column(0), width):
                x = matrix(part, width)
                n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        columns = [pa.array([n] * width, pa.int64()), pa.array(range(width), pa.int32()), pa.array(high), pa.array(low)]
        yield pa.RecordBatch.from_arrays(columns, names=["n", "at", "high", "low"])

    rows = fitted.mapInArrow(run, "n bigint, at int, high bigint, low bigint").groupBy("at").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")))
    found = sorted(rows.collect())  # one row a dimension
    return int(found[0].n), tuple((int(r.high) << 32) + int(r.low) for r in found)


def scatter(fitted: DataFrame, width: int, centred: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of c c' over the vectors c = centred(x), of the given size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for part in parts(batch.column(0), width):
                c = centred(matrix(part, width))
                total += c.T @ c
        if total.any():
            yield packed(dict(enumerate(total)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows[at] = rows.get(at, 0) + np.frombuffer(row)
        yield packed(rows)

    def packed(rows: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows.keys(), pa.int32()), pa.array([r.tobytes() for r in rows.values()], pa.binary())], names=["at", "row"])

    schema = "at int, row binary"
    summed = fitted.mapInArrow(add, schema).repartition(min(size, shuffle_partitions(fitted.sparkSession)), "at").mapInArrow(merge, schema)
    total = np.zeros((size, size))
    for r in summed.toLocalIterator():
        total[r["at"]] = np.frombuffer(r.row)
    return total


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): v[order][:, order] = L L', L with as many columns as v has rank, of falling diagonal entries."""
    rest, d = v.copy(), len(v)
    order, least = np.arange(d), d * np.finfo(float).eps * max(v.diagonal().max(initial=0), 0)
    columns = np.zeros((d, d))
    for k in range(d):
        pivot = k + int(np.argmax(rest.diagonal()[k:]))
        if rest[pivot, pivot] <= least:
            return columns[:, :k], order
        if pivot != k:
            swap, by = [k, pivot], [pivot, k]
            order[swap], columns[swap], rest[swap] = order[by], columns[by], rest[by]
            rest[:, swap] = rest[:, by]
        columns[k:, k] = rest[k:, k] / np.sqrt(rest[k, k])
        rest[k + 1 :, k + 1 :] -= np.outer(columns[k + 1 :, k], columns[k + 1 :, k])
    return columns, order


def orthogonal(columns: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns, rotated in pairs until all are orthogonal to working precision. Disjoint pairs are rotated at once."""
    rows = columns.T.copy()
    r = len(rows)
    if r < 2:
        return rows.T
    ring = list(range(r + r % 2))  # with a bye for odd numbers
    tolerance = np.finfo(float).eps * np.sqrt(columns.shape[0])
    for _ in range(sweeps):
        largest = 0.0
        for _ in range(len(ring) - 1):
            pairs = np.array([p for p in zip(ring[: len(ring) // 2], reversed(ring[len(ring) // 2 :]), strict=True) if max(p) < r])
            ring = [ring[0], ring[-1], *ring[1:-1]]
            a, b = rows[pairs[:, 0]], rows[pairs[:, 1]]
            aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                off = np.where(ab == 0, 0, np.abs(ab) / np.sqrt(aa * bb))
                slope = (bb - aa) / (2 * ab)
                tangent = np.where(off > tolerance, np.where(slope < 0, -1, 1) / (np.abs(slope) + np.sqrt(1 + slope * slope)), 0)
            largest = max(largest, off.max())
            cos = 1 / np.sqrt(1 + tangent * tangent)
            sin = cos * tangent
            rows[pairs[:, 0]], rows[pairs[:, 1]] = cos[:, None] * a - sin[:, None] * b, sin[:, None] * a + cos[:, None] * b
        if largest <= tolerance:
            break
    return rows.T


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit columns) of a positive semidefinite matrix, falling, as many as its rank. A column's largest entry is positive."""
    factor, order = pivoted_cholesky(v)
    rotated = np.zeros_like(factor)
    rotated[order] = orthogonal(factor)
    norms = np.sqrt((rotated * rotated).sum(axis=0))
    by = np.argsort(-norms, kind="stable")
    units = rotated[:, by] / norms[by]
    if units.size:
        units = units * np.sign(units[np.abs(units).argmax(axis=0), np.arange(units.shape[1])])
    return norms[by] ** 2, units


def fit(df: DataFrame, *, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of df; None if there are none."""
    fitted = saved(df.select(grid(F.col(vector_col)).alias("x")).where("x is not null").distinct())
    first = fitted.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if first is None:
        return None
    width = first.width
    fitted = fitted.where(F.size("x") == width)
    n, sums = exact_sums(fitted, width)
    v = scatter(fitted, width, lambda x: from_sums(x, n, sums).astype(np.float64) / n, width) / n
    values, units = eigen(v)
    values, units = values[:components], units[:, :components]
    error = 0.0
    if len(values):
        onto = units / np.sqrt(values)
        unit = scatter(fitted, width, lambda x: from_sums(x, n, sums).astype(np.float64) / n @ onto, len(values)) / n
        error = float(np.abs(unit - np.eye(len(values))).max())
    return Whitening(n, sums, values, units, float(v.trace()), error)


def whiten(df: DataFrame, model: Whitening | None, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, deviation: sum of (n * x - S) ** 2, whitened: array<double>) of each row of df that has a vector of the model's length."""
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    rows = df.select(F.col(id_col).alias("id"), grid(F.col(vector_col)).alias("x")).where("x is not null")
    if model is None:
        return rows.where("false").select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
    width, onto, n, sums = len(model.sums), model.components / np.sqrt(model.values), model.n, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in parts(batch.column(1), width):
                off = from_sums(matrix(part, width), n, sums)
                white = off.astype(np.float64) / n @ onto
                ends = pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1])
                columns = [batch.column(0).slice(at, len(part)), pa.array(deviations(off), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(white.ravel()))]
                at += len(part)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.where(F.size("x") == width).mapInArrow(run, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a vector and component, of the first 16, with the vector's exact deviation and the component's share."""
    vectors = table(spark, sf_dir, "embeddings")
    model = fit(vectors)
    rows = whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = [] if model is None else (model.values / model.trace).tolist()
    explained = F.element_at(F.array(*(F.lit(s) for s in shares)).cast("array<double>"), F.col("at") + 1)
    n, error = (0, 0.0) if model is None else (model.n, model.identity_error)
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))
