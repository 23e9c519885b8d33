"""Whitening of embeddings: projections on the leading eigenvectors of their covariance.

Components of vectors are whole numbers, so sums and the covariance are exact whatever the order in
which tasks add them up: rows are centred by the rounded mean, multiplied, and the rest of the mean
(under one half) is taken off in whole numbers on the driver, which holds one number per pair of
dimensions. The eigenvectors come from a float32 decomposition that is refined by the matrix
products of Ogita and Aishima, in double and at last in extended precision. Eigenvalues too close
for the refinement to tell apart form clusters: each is shifted to zero, solved anew within its own
subspace, by the same method, and the refinement goes on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import stored
from riskflow.llm.topk import quantised

CHUNK_ROWS = 4096
EXACT = 1 << 53  # whole numbers below it are exact as doubles
LARGEST = (1 << 63) - 1
ROUNDS = 12
DEPTH = 4


@dataclass(frozen=True)
class Whitening:
    """What the fit list gave: its size and sums, and the leading components as rows.

    ``values`` are their eigenvalues, ``explained`` their shares of the trace, ``error`` the
    largest absolute entry of the whitened fit list's covariance minus the identity. A component
    without variance has eigenvalue 0 and no whitened value, and takes no part in ``error``.
    """

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    error: float | None = None

    @property
    def width(self) -> int:
        return len(self.sums)


def refined(matrix: np.ndarray, start: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Eigenvectors (columns) of a symmetric matrix from approximate ones, by rounds of products.

    A round takes the residuals of orthogonality and of the eigenvalues, and adds to each vector
    its error along every other one. For two eigenvalues closer than the round can tell, only
    orthogonality is restored; such clusters are solved apart before the next round.
    """
    x, best, least = start.astype(matrix.dtype), start.astype(matrix.dtype), np.inf
    unit = np.eye(len(matrix), dtype=matrix.dtype)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0))
    reached = scale * len(matrix) * float(np.finfo(matrix.dtype).eps)
    for _ in range(ROUNDS):
        r = unit - x.T @ x
        s = x.T @ matrix @ x
        s = (s + s.T) / 2  # rounding that differs in s and its transpose would undo orthogonality
        values = np.diag(s) / (1 - np.diag(r))
        rest = s - np.diag(values)
        off = float(np.linalg.norm(rest.astype(float))) + scale * float(np.linalg.norm(r.astype(float)))
        if off < least:
            best, least = x, off
        if off <= reached:
            break
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > 2 * off
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
        x = x + x @ e
        if depth:
            for own in _clusters(values.astype(float), 2 * off):
                x[:, own] = _within(matrix, x[:, own], depth - 1)
    return best


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of eigenvalues that a chain of gaps of at most ``gap`` joins, two or more each."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def _within(matrix: np.ndarray, vectors: np.ndarray, depth: int) -> np.ndarray:
    """Vectors of one cluster turned so that they are eigenvectors within what they span.

    The matrix is shifted by the cluster's mean value first, so that its small differences are
    what the solver sees.
    """
    shift = np.trace(vectors.T @ matrix @ vectors) / np.trace(vectors.T @ vectors)
    own = vectors.T @ (matrix @ vectors - shift * vectors)
    return vectors @ _solved((own + own.T) / 2, depth)


def _solved(matrix: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    largest = np.abs(matrix).max(initial=0)
    if largest == 0:
        return np.eye(len(matrix), dtype=matrix.dtype)
    scaled = matrix / largest
    start = np.linalg.eigh(scaled.astype(np.float32))[1]
    return refined(scaled, start, depth)


def eigenpairs(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors (rows) of a symmetric matrix.

    float32 start, refinement in double, and the last rounds in numpy's longest type.
    """
    fine = matrix.astype(np.longdouble)
    largest = np.abs(fine).max(initial=0)
    if largest == 0:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    scaled = fine / largest
    x = refined(scaled, _solved(scaled.astype(np.float64)))
    x = x / np.sqrt((x * x).sum(axis=0))
    values = np.einsum("ij,ij->j", x, scaled @ x) * largest
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order].T


def whole_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                  scale: int = 256) -> tuple[DataFrame, int]:
    """Rows (vec_id, vector of longs) and the width of the longest vector.

    Rows whose vector is null or holds a null or a value that is not finite are left out; a shorter
    vector is filled up with zeros.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"),
                          quantised(F.col(vector_col), scale).alias("vector")).where("vector is not null")
    width, least = rows.agg(F.max(F.size("vector")), F.min(F.size("vector"))).first()
    if width != least:
        short = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector"))
        rows = rows.withColumn("vector", F.concat("vector", short))
    return rows, width or 0


def _rows_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    lists = batch.column("vector")
    return lists.flatten().to_numpy().reshape(-1, width)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension."""
    row = fit.agg(F.count("*"), *[F.sum(F.col("vector")[i].cast("decimal(38,0)")) for i in range(width)])
    n, *sums = row.first()
    return n, [int(s or 0) for s in sums]


def _products(fit: DataFrame, centre: list[int]) -> list[list[int]]:
    """Sums over the vectors of all products of two dimensions, each less its centre.

    A task adds up its own rows in whole numbers; a row of the result per dimension and task meets
    the others in one grouping, which Spark adds up as decimals.
    """
    width, at = len(centre), np.array(centre, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), dtype=object)
        for batch in batches:
            rows = _rows_of(batch, width) - at
            for i in range(0, len(rows), CHUNK_ROWS):
                part = rows[i:i + CHUNK_ROWS]
                bound = max(int(part.max()), -int(part.min())) ** 2 * len(part)
                if bound < EXACT:
                    fine = part.astype(np.float64)
                    total += (fine.T @ fine).astype(np.int64)
                else:
                    fine = part if bound <= LARGEST else part.astype(object)
                    total += fine.T @ fine
        if total.any():
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(width), pa.int32()),
                "row": pa.array([[str(v) for v in row] for row in total], pa.list_(pa.string())),
            })

    parts = fit.select("vector").mapInArrow(run, "i int, row array<string>")
    added = parts.select("i", F.posexplode("row").alias("j", "value")).groupBy("i", "j").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out = [[0] * width for _ in range(width)]
    for i, j, value in added.collect():  # one per pair of dimensions
        out[i][j] = int(value)
    return out


def fit_whitening(rows: DataFrame, width: int, components: int = 4) -> Whitening:
    """The whitening of the distinct vectors of ``rows`` (vec_id, vector of ``width`` longs)."""
    fit = stored(rows.select("vector").distinct(), "fit-list")
    n, sums = _sums(fit, width)
    if not n or not width:
        return Whitening(n, tuple(sums), np.zeros((0, width)), np.zeros(0), np.zeros(0))
    centre = [(2 * s + n) // (2 * n) for s in sums]  # the rounded means
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    products = _products(fit, centre)
    covariance = np.array([
        [_quotient(n * products[i][j] - rest[i] * rest[j], n * n) for j in range(width)]
        for i in range(width)
    ], dtype=np.longdouble)
    values, vectors = eigenpairs(covariance)
    trace = np.trace(covariance)
    values = np.where(values > width * np.finfo(float).eps * values[0], values, 0)[:components]
    share = (values / trace if trace else np.zeros(len(values))).astype(float)
    model = Whitening(n, tuple(sums), vectors[:components].astype(float), values.astype(float), share)
    return Whitening(model.n, model.sums, model.components, model.values, share, _error(fit, model))


def _quotient(a: int, b: int) -> np.longdouble:
    """a / b of whole numbers of any size, to the longest type."""
    whole, part = divmod(a, b)
    return np.longdouble(whole) + np.longdouble(part) / np.longdouble(b)


def _centred(rows: np.ndarray, model: Whitening) -> tuple[np.ndarray, bool]:
    """n * x - S, and whether its squares add up within a long."""
    sums = np.array(model.sums, dtype=object)
    reach = model.n * int(np.abs(rows).max(initial=0)) + max(abs(s) for s in model.sums)
    if reach ** 2 * model.width <= LARGEST:
        return model.n * rows - sums.astype(np.int64), True
    return model.n * rows.astype(object) - sums, False


def _project(rows: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Whitened values (not a number without variance) and deviations of some rows."""
    wide, fits = _centred(rows, model)
    squares = (wide * wide).sum(axis=1)
    if not fits and squares.max(initial=0) > LARGEST:
        raise OverflowError("a deviation is beyond a long")
    factors = model.components.T / np.sqrt(np.where(model.values > 0, model.values, np.nan))
    return (wide.astype(float) / model.n) @ factors, squares.astype(np.int64)


def _error(fit: DataFrame, model: Whitening) -> float | None:
    kept = int((model.values > 0).sum())
    width = model.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kept, kept + 1))
        for batch in batches:
            w = _project(_rows_of(batch, width), model)[0][:, :kept]
            total += np.hstack([w.T @ w, w.sum(axis=0)[:, None]])
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(range(kept), pa.int32()), "row": pa.array(total.tolist(), pa.list_(pa.float64())),
        })

    if not kept:
        return None
    parts = fit.select("vector").mapInArrow(run, "i int, row array<double>")
    rows = parts.groupBy("i").agg(*[F.sum(F.col("row")[j]) for j in range(kept + 1)]).collect()
    found = np.array([row[1:] for row in sorted(rows)]) / model.n
    mean = found[:, kept]
    return float(np.abs(found[:, :kept] - np.outer(mean, mean) - np.eye(kept)).max())


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (long) and the whitened vector of each row, null without variance."""
    width, kind = model.width, rows.schema["vec_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, squares = _project(_rows_of(batch, width), model)
            flat = pa.array(found.ravel(), from_pandas=True)  # not a number becomes null
            size = found.shape[1]
            lists = pa.ListArray.from_arrays(np.arange(0, flat.__len__() + 1, size, dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(squares), lists], names=["vec_id", "deviation", "whitened"])

    schema = f"vec_id {kind.simpleString()}, deviation long, whitened array<double>"
    if not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(run, schema)


def whiten(vectors: DataFrame, components: int = 4, *, id_col: str = "vec_id",
           vector_col: str = "embedding", scale: int = 256) -> tuple[DataFrame, Whitening]:
    """Whitened rows (vec_id, deviation, whitened) of all usable vectors, and the fit.

    A component x of a vector becomes floor(scale * x). Vectors that are null or hold nulls or
    values that are not finite have no row; shorter ones are filled up with zeros, and empty ones
    alone have no dimension and so no row. Null ids and repeated rows are kept; equal vectors count
    once in the fit. Ties between eigenvalues leave the choice of vectors in their space open, the
    same for all rows. Fewer components than asked for come from narrower vectors. An empty table
    gives no row. Other columns are not read. A deviation beyond a long is an error.
    """
    rows, width = whole_vectors(vectors, id_col=id_col, vector_col=vector_col, scale=scale)
    model = fit_whitening(rows, width, components)
    return whitened(rows, model), model
