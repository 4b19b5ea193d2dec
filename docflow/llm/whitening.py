"""Whitening of embeddings on their leading principal components, by contour integration.

1. Entries become integers (``floor(64 c) + 1000000``); the fit list is every
   distinct vector once. Counts and sums are exact.
2. The covariance is summed in tasks over centred rows and added up by Spark;
   it has as many rows as a vector has entries (``MAX_DIM`` at most).
3. Inertia counts (negative pivots of the shifted covariance in tridiagonal
   form) cut the part of the spectrum that is wanted into intervals of few
   eigenvalues each, the cuts lying in gaps. Every interval is one row, and
   its task runs FEAST: Gauss quadrature of (zI - V)^-1 Y on the circle
   around the interval projects onto its eigenvectors, Rayleigh-Ritz extracts
   them, and this is repeated until the residuals vanish. An interval that
   does not give as many pairs as its inertia count says is an error, so no
   component is missed.
4. A last Rayleigh-Ritz step over all vectors found makes them orthogonal; all
   rows are centred and projected in tasks.

Defined results
- null vectors, empty ones, and ones with null, NaN or infinite entries, or
  with entries that do not fit (|64 c| from 2^52 on), are left out; so are
  those of another length than the most frequent one (the longer if equal);
- repeated vectors and rows: each counts once in the fit and is returned each
  time; null ids are kept;
- components whose eigenvalue is zero to rounding (constant entries, fewer
  vectors than entries) have no whitened value and are not returned; equal
  eigenvalues share their space, in any basis of it;
- no row or one distinct vector: no components, so no rows;
- other columns of any name are not read, and none is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import ready, staged

SCALE, OFFSET, LIMIT = 64, 1_000_000, 2 ** 52
#: The covariance is held whole by every task: so many entries of a vector at most (32 MB).
MAX_DIM = 2048
#: Eigenvalues wanted in an interval, and quadrature nodes on its upper half circle.
PER_INTERVAL, NODES = 4, 8
#: Partial matrices of tasks are added up in so many lots first.
LOTS = 64
EPS = float(np.finfo(np.float64).eps)


def integers(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The rows that remain, as (id, x array<bigint>), written to the shared folder."""
    wide = F.transform(vector_col, lambda c: c.cast("double") * SCALE)
    # a comparison with a null or NaN entry never holds: NaN is the greatest value in Spark
    sound = F.forall(wide, lambda c: c.isNotNull() & (c < float(LIMIT)) & (c > -float(LIMIT)))
    rows = table.select(F.col(id_col).alias("id"), F.when(sound, F.transform(wide, lambda c: F.floor(c) + OFFSET)).alias("x"))
    rows = staged(rows.where("x IS NOT NULL AND size(x) > 0"), "integers")
    most = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.where(F.size("x") == (most[0] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column (all of one length) as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


@dataclass
class Centre:
    """Number and exact sums of the fit list; a mean is ``base + rest / n``."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.base = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """The exact sum of (n x - S)^2 of every row."""
        y = x - self.base
        far = int(np.abs(y).max(initial=0)) + 1
        if y.shape[1] * (far * self.n) ** 2 < 2 ** 62:
            step = self.n * y - self.rest
            return (step * step).sum(axis=1).tolist()
        step = self.n * y.astype(object) - self.rest.astype(object)
        return (step * step).sum(axis=1).tolist()


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and place: the sum of the entries, as text (exact at any size)."""
    for batch in batches:
        x = _matrix(batch.column("x"))
        if len(x):
            high, low = (x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0)
            total = [str(int(h) * 2 ** 20 + int(v)) for h, v in zip(high, low)]
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(total), pa.array([len(x)] * len(total), pa.int64())],
                                  names=["place", "total", "rows"])


def centre(fit: DataFrame) -> Centre | None:
    """Exact count and sums of the fit list; None if it is empty."""
    per_place = fit.mapInArrow(_sums, "place int, total string, rows bigint").groupBy("place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("rows").alias("rows"))
    found = sorted(per_place.collect())                     # one row per entry of a vector
    if len(found) > MAX_DIM:
        raise ValueError(f"vectors of {len(found)} entries; the covariance is held whole up to {MAX_DIM}")
    return Centre(int(found[0][2]), [int(r[1]) for r in found]) if found else None




def second_moments(fit: DataFrame, mid: Centre, project: np.ndarray | None = None) -> np.ndarray:
    """The covariance of the fit list, centred before multiplying; of its projection if one is given."""
    size = len(mid.sums) if project is None else project.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((size, size)), False
        for batch in batches:
            x = _matrix(batch.column("x"))
            if len(x):
                y = mid.centred(x)
                y = y if project is None else y @ project
                total, some = total + y.T @ y, True
        if some:
            lot = TaskContext.get().partitionId() % LOTS
            yield pa.record_batch([pa.array([lot] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array(list(total))],
                                  names=["lot", "i", "row"])

    def add(table: pa.Table) -> pa.Table:
        row = _matrix(table.column("row").combine_chunks()).sum(axis=0)
        return pa.table({"lot": pa.array([0], pa.int32()), "i": table.column("i").slice(0, 1), "row": pa.array([row])})

    schema = "lot int, i int, row array<double>"
    rows = fit.mapInArrow(partial, schema)
    rows = rows.groupBy("lot", "i").applyInArrow(add, schema).groupBy("i").applyInArrow(add, schema)
    found = sorted((r["i"], r["row"]) for r in rows.collect())   # one row per entry of a vector
    whole = np.array([r for _, r in found]) / mid.n
    return (whole + whole.T) / 2


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and side diagonal of an orthogonally similar tridiagonal matrix (Householder)."""
    a = matrix.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1:, k]
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        v /= np.linalg.norm(v)
        a[k + 1:, k:] -= 2 * np.outer(v, v @ a[k + 1:, k:])
        a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(tri: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Eigenvalues above ``shift``: the positive pivots of the shifted matrix (Sylvester's law of inertia)."""
    diagonal, side = tri
    tiny = EPS * (np.abs(diagonal).max(initial=0) + np.abs(side).max(initial=0)) * EPS + np.finfo(np.float64).tiny
    above, pivot = 0, 1.0
    for k, a in enumerate(diagonal):
        pivot = a - shift - (side[k - 1] ** 2 / pivot if k else 0.0)
        if pivot == 0:
            pivot = -tiny
        above += pivot > 0
    return int(above)


def intervals(tri: tuple[np.ndarray, np.ndarray], wanted: int, top: float, floor: float) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) that hold the ``wanted`` greatest eigenvalues above ``floor``.

    Intervals are halved until few eigenvalues are in one; a cut that splits a
    cluster is moved into the widest gap near by that the counts show.
    """
    out = []
    todo = [(floor, top, count_above(tri, floor))]
    while todo:
        low, high, inside = todo.pop()
        over = count_above(tri, high)
        if inside == 0 or over >= wanted:
            continue
        if inside <= PER_INTERVAL or high - low <= 64 * EPS * top:
            out.append((low, high, inside))
            continue
        cut, best = (low + high) / 2, -1.0
        for at in np.linspace(low + 0.3 * (high - low), low + 0.7 * (high - low), 17):
            here, gap = count_above(tri, at), (high - low) * 0.25
            while gap > (high - low) * 1e-4 and not count_above(tri, at - gap) == here == count_above(tri, at + gap):
                gap /= 2
            if gap > best:
                cut, best = float(at), gap
        above = count_above(tri, cut) - over
        todo += [(low, cut, inside - above), (cut, high, above)]
    return out


def feast(matrix: np.ndarray, low: float, high: float, inside: int, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The eigenpairs of a symmetric matrix in (low, high], of which there are ``inside``.

    The subspace is twice as wide as the count, and grows if the pairs do not settle.
    """
    d = len(matrix)
    mid, radius = (low + high) / 2, (high - low) / 2
    places, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(1j * np.pi * (places + 1) / 2)
    solvers = [np.linalg.inv((mid + radius * z) * np.eye(d) - matrix) for z in turns]
    scale = np.abs(matrix).sum(axis=1).max()
    rng = np.random.default_rng(0)
    width = min(d, 2 * inside + 4)
    space = rng.standard_normal((d, width))
    for turn in range(rounds):
        gathered = sum(w * radius / 2 * np.real(z * (inverse @ space)) for w, z, inverse in zip(weights, turns, solvers))
        basis, _ = np.linalg.qr(gathered)
        values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ inner
        residual = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
        settled = (values > low) & (values <= high) & (residual <= 8 * d * EPS * scale)
        if settled.sum() == inside:
            return values[settled], vectors[:, settled]
        space = vectors
        if turn % 15 == 14 and width < d:
            width = min(d, 2 * width)
            space = np.hstack([vectors, rng.standard_normal((d, width - vectors.shape[1]))])
    raise ArithmeticError(f"{int(settled.sum())} of {inside} eigenpairs found between {low} and {high}")


def components(spark, covariance: np.ndarray, wanted: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their unit eigenvectors (columns); one task per interval."""
    d = len(covariance)
    top = float(np.abs(covariance).sum(axis=1).max()) * (1 + 1e-9)
    floor = 64 * d * EPS * top
    if top <= 0:
        return np.zeros(0), np.zeros((d, 0))
    tri = tridiagonal(covariance)
    cuts = intervals(tri, wanted, top, floor)
    if not cuts:
        return np.zeros(0), np.zeros((d, 0))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, inside in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "inside"))):
                values, vectors = feast(covariance, low, high, inside)
                yield pa.record_batch([pa.array(values), pa.array(list(vectors.T))], names=["value", "vector"])

    rows = spark.createDataFrame(cuts, "low double, high double, inside int").repartition(len(cuts), "low")
    found = rows.mapInArrow(solve, "value double, vector array<double>").collect()      # few vectors of one covariance
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in found]).T)
    values, inner = np.linalg.eigh(basis.T @ covariance @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], (basis @ inner)[:, order]


def whiten(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = 16) -> DataFrame:
    """(id, component, n, deviation decimal(38,0), whitened, explained, identity_error), a row per vector and component."""
    spark = table.sparkSession
    schema = (f"{id_col} {table.schema[id_col].dataType.simpleString()}, component int, n bigint, deviation decimal(38,0), "
              "whitened double, explained double, identity_error double")
    ready(spark)
    rows = integers(table, id_col, vector_col)
    fit = staged(rows.select("x").distinct(), "fit")
    mid = centre(fit)
    covariance = second_moments(fit, mid) if mid else np.zeros((0, 0))
    values, vectors = components(spark, covariance, wanted) if mid else (np.zeros(0), np.zeros((0, 0)))
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    scaled = vectors / np.sqrt(values)
    error = float(np.abs(second_moments(fit, mid, scaled) - np.eye(k)).max())
    explained = values / np.trace(covariance)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"))
            if not len(x):
                continue
            rows_of = np.repeat(np.arange(len(x)), k)
            far = pa.array([Decimal(v) for v in mid.deviations(x)], pa.decimal128(38, 0))
            yield pa.record_batch([
                batch.column("id").take(pa.array(rows_of)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows_of), mid.n)), far.take(pa.array(rows_of)),
                pa.array((mid.centred(x) @ scaled).ravel()), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(rows_of), error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
