"""Embedding whitening: pivoted Cholesky, then one-sided Jacobi.

The fit list (each distinct integer vector once) is summed in Spark: every
task adds up its rows' count, sums and centred products as exact integers,
and a group-by over matrix cells adds the tasks' parts. Vectors are centred
before they are multiplied, by the mean rounded to integers; the remainder of
the mean is below one half and is taken off the exact sums afterwards, so the
scatter has no rounding error whatever the partitioning.

The d x d scatter is factored with diagonal pivoting into a triangular factor
L. One-sided Jacobi rotates the columns of L until they are orthogonal: their
squared norms are the eigenvalues, the normalised columns the components.
Only matrices of the vectors' width reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import read_table, written
from ledgerlens.llm.vectors import exact_product, matrix, scaled, stacked

#: Widest vectors: the scatter's cells are summed one row each.
MAX_WIDTH = 2048
#: Sweeps over all column pairs after which Jacobi must have converged.
MAX_SWEEPS = 60


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with scatter[order][:, order] = L L^T. L has one column per
    pivot above rounding error, so its width is the numerical rank."""
    d = len(scatter)
    order, left = np.arange(d), scatter.diagonal().copy()
    factor = np.zeros((d, d))
    least = d * np.finfo(float).eps * left.max(initial=0)
    rank = 0
    for k in range(d):
        p = k + int(left[k:].argmax())
        if left[p] <= least:
            break
        order[[k, p]], left[[k, p]], factor[[k, p]] = order[[p, k]], left[[p, k]], factor[[p, k]]
        factor[k, k] = np.sqrt(left[k])
        column = scatter[order[k + 1:], order[k]] - factor[k + 1:, :k] @ factor[k, :k]
        factor[k + 1:, k] = column / factor[k, k]
        left[k + 1:] -= factor[k + 1:, k] ** 2
        rank = k + 1
    return factor[:, :rank], order


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs below n (even), as n - 1 rounds of disjoint pairs."""
    ring = list(range(n))
    for _ in range(n - 1):
        yield np.array(ring[:n // 2]), np.array(ring[:n // 2 - 1:-1])
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` times rotations, with orthogonal columns. All pairs of a
    round are rotated at once."""
    d, rank = factor.shape
    cols = np.zeros((rank + rank % 2, d))
    cols[:rank] = factor.T
    if rank < 2:
        return cols[:rank].T
    close = np.finfo(float).eps * np.sqrt(d)
    for _ in range(MAX_SWEEPS):
        turned = False
        for p, q in _rounds(len(cols)):
            a, b = cols[p], cols[q]
            aa, bb, ab = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
            todo = np.abs(ab) > close * np.sqrt(aa * bb)
            if not todo.any():
                continue
            turned = True
            p, q, a, b, aa, bb, ab = p[todo], q[todo], a[todo], b[todo], aa[todo], bb[todo], ab[todo]
            zeta = (bb - aa) / (2 * ab)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            cols[p], cols[q] = c[:, None] * a - s[:, None] * b, s[:, None] * a + c[:, None] * b
        if not turned:
            return cols[:rank].T
    raise ArithmeticError("the rotations did not converge")


def principal(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a positive
    semidefinite matrix; as many as its numerical rank."""
    factor, order = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(factor)
    values = (turned * turned).sum(0)
    rank = np.argsort(-values, kind="stable")
    components = np.zeros_like(turned)
    components[order] = turned[:, rank] / np.sqrt(values[rank])
    return values[rank], components


@dataclass(frozen=True)
class Whitening:
    """A fit: ``n`` distinct vectors of sums n * base + rest; components
    (columns) of the covariance by falling eigenvalue; trace of it."""

    n: int
    base: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.base)


def _cells(rows: DataFrame, base: np.ndarray, products: bool) -> dict[tuple[int, int], int]:
    """Exact sums over the rows of x - base (cells (i, -1)) and, with
    ``products``, of its products (cells (i, j), i <= j)."""
    width = len(base)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width, object)
        square = np.zeros((width, width), object)
        some = False
        for table in stacked(batches):
            y, some = matrix(table["_x"], width) - base, True
            sums += exact_product(np.ones((1, len(y)), np.int64), y)[0].astype(object)
            if products:
                square += exact_product(y.T.copy(), y).astype(object)
        if not some:
            return
        i, j = np.triu_indices(width) if products else (np.zeros(0, int), np.zeros(0, int))
        values = [*sums.tolist(), *square[i, j].tolist()]
        high, low = zip(*((int(v) >> 64, int(v) & (1 << 64) - 1) for v in values))
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(width), *i.tolist()], pa.int32()), pa.array([-1] * width + j.tolist(), pa.int32()),
             pa.array(map(Decimal, high), kind), pa.array(map(Decimal, low), kind)], names=["i", "j", "high", "low"])

    found = (rows.mapInArrow(parts, "i int, j int, high decimal(38,0), low decimal(38,0)")
             .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")))
    return {(r["i"], r["j"]): (int(r["high"]) << 64) + int(r["low"]) for r in found.collect()}


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct ``_x`` once, written to the shared folder."""
    return written(rows.select("_x").distinct(), "whitening-fit")


def fit(vectors: DataFrame) -> Whitening | None:
    """The whitening of a fit list; None when it has no entries at all."""
    n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("_x"))).first()
    if not n or not width:
        return None
    if width > MAX_WIDTH:
        raise ValueError(f"vectors of up to {MAX_WIDTH} entries are expected, not {width}")
    total = _cells(vectors, np.zeros(width, np.int64), products=False)
    base = [round(total[i, -1] / n) if abs(total[i, -1]) < 1 << 52 else (2 * total[i, -1] + n) // (2 * n) for i in range(width)]
    rest = [total[i, -1] - n * base[i] for i in range(width)]
    base = np.array(base, np.int64)
    cells = _cells(vectors, base, products=True)
    # n times the scatter about the mean, exact, then one rounding a cell.
    spread = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            exact = n * cells[i, j] - rest[i] * rest[j]
            spread[i, j] = spread[j, i] = exact / (n * n)
    values, components = principal(spread)
    return Whitening(n, base, np.array(rest, object), values, components, float(spread.trace()))


def project(rows: DataFrame, model: Whitening, most: int) -> DataFrame:
    """``rows`` (_id, _x) as (_id, deviation, white): the exact squared
    deviation from the mean times n^2 as decimal(38,0) (null beyond), and the
    coordinates on the first ``most`` components over the root of their
    eigenvalue."""
    width, n, base = model.width, model.n, model.base
    off = np.array([r / n for r in model.rest])
    axes = model.components[:, :most] / np.sqrt(model.values[:most])
    rest = model.rest
    rest_square, most_digits = sum(int(r) * int(r) for r in rest), 10 ** 38
    id_type = rows.schema["_id"].dataType.simpleString()

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in stacked(batches):
            y = matrix(table["_x"], width) - base
            largest = int(np.abs(y).max(initial=0))
            wide = y if largest ** 2 * width < 1 << 62 else y.astype(object)
            square = (wide * wide).sum(1).astype(object)
            cross = y.astype(object) @ rest if width * largest * int(abs(rest).max()) >= 1 << 62 else (
                y @ rest.astype(np.int64)).astype(object)
            exact = n * n * square - 2 * n * cross + rest_square
            white = (y - off) @ axes
            ids = table["_id"].combine_chunks()
            yield pa.RecordBatch.from_arrays([
                ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids,
                pa.array([Decimal(v) if v < most_digits else None for v in exact.tolist()], pa.decimal128(38, 0)),
                pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), white.shape[1]).cast(pa.list_(pa.float64()))],
                names=["_id", "deviation", "white"])

    return rows.mapInArrow(projected, f"_id {id_type}, deviation decimal(38,0), white array<double>")


def identity_error(white: DataFrame, most: int) -> float:
    """Largest absolute entry of the covariance (divisor n) of ``white`` minus
    the identity; Spark's covariance is centred as it runs."""
    cells = [(i, j) for i in range(most) for j in range(i, most)]
    found = white.agg(*[F.covar_pop(F.col("white")[i], F.col("white")[j]) for i, j in cells]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, cells))


SCHEMA = "vec_id {}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 4) -> DataFrame:
    """One row per row and component, up to ``components``: (id, component,
    n, deviation, whitened, explained, identity_error).

    Vectors that are null, hold null or non-finite entries or entries beyond a
    long (times 256) take no part. Of equal integer vectors one is in the fit
    list, all rows are returned (repeated rows and null ids too). Vectors
    shorter than the longest are taken to end in zeros. Components are as many
    as the covariance's numerical rank allows: one distinct vector, or none,
    gives no rows, as no direction has variance. Other columns are ignored.
    """
    rows = scaled(table, id_col, vec_col)
    vectors = fit_list(rows)
    model = fit(vectors)
    most = min(components, len(model.values)) if model else 0
    if not most:
        kind = rows.schema["_id"].dataType.simpleString()
        return table.sparkSession.createDataFrame([], SCHEMA.format(kind)).withColumnRenamed("vec_id", id_col)
    error = identity_error(project(vectors.select(F.lit(0).alias("_id"), "_x"), model, most), most)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values[:most]])
    return (project(rows, model, most)
            .select("_id", "deviation", F.posexplode("white").alias("_k", "whitened"))
            .select(F.col("_id").alias(id_col), (F.col("_k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", "whitened", explained[F.col("_k")].alias("explained"),
                    F.lit(float(error)).alias("identity_error")))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened coordinates of all ``embeddings``; a deviation
    beyond a long is null."""
    return whiten(read_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


QUERIES = {"op11_embedding_whitening": op11_embedding_whitening}
