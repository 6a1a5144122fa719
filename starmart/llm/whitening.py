"""Whitening of embeddings by shifted CholeskyQR over rows that stay distributed.

A vector ``c`` is read as the whole numbers ``x = floor(256 c)``. What is fitted is every distinct ``x``
once. With ``n`` of them and their sums ``S``, row by row ``C = (n x - S) / n`` is centred in exact
integers before anything is multiplied.

1. ``fit_list`` stores the distinct vectors; ``sums_of`` adds them up exactly.
2. ``orthogonalise``: each pass takes the rows through the triangular solves so far, ``Q = C R^-1``, and
   adds up the Gram matrix of ``Q``. Its Cholesky factor joins the factors, and ``R`` is their product. The
   first Gram matrix is shifted by the rounding its sums can carry, so that it has a factor whatever the
   condition of ``C``; the later passes take the shift out again. It ends when ``Q`` has orthonormal columns.
3. ``C = Q R``, so the right singular vectors of ``R`` are the components and its squared singular values
   over ``n`` the variances: the covariance itself, whose condition is squared, is never decomposed.
4. ``whiten`` projects every row. How far the covariance of the whitened fit list is from the identity is
   measured by a pass of its own.

Every pass sends sums of ``d x d`` numbers, first added up per task; ``d`` is the length of a vector. No
rows are gathered in the driver.

Defined results: a row whose vector is null, or holds null, infinite or not-a-number entries, is left
out, as are rows whose vector is not as long as most are (the longer at a tie). Repeated rows and ids are
rows of their own, fitted once. Empty tables, and vectors without entries, give no rows. A component
whose standard deviation is not above ``ROUNDING`` of the first one's has no direction to scale: its
``whitened`` is null, its ``explained`` 0. A ``deviation`` beyond 64 bits is null. Columns other than id
and vector are not used, whatever their names. The sign of a component is the one that makes its
largest entry positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import forget, stored

SCALE = 256
MOST_PASSES = 8
ROUNDING = 1e-13
UNIT = np.finfo(np.float64).eps / 2
OUT = (
    "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` of the rows whose vector has finite entries only."""
    number = lambda v: v.cast("double")
    finite = F.forall(embedding, lambda v: v.isNotNull() & (F.abs(number(v)) < F.lit(float("inf"))))
    return rows.filter(F.col(embedding).isNotNull() & finite).select(
        F.col(vec_id).alias("vec_id"), F.transform(embedding, lambda v: F.floor(SCALE * number(v))).alias("x")
    )


def usual_length(vectors: DataFrame) -> int:
    """The most frequent number of entries; 0 without rows."""
    counts = vectors.groupBy(F.size("x").alias("d")).count()
    row = counts.orderBy(F.desc("count"), F.desc("d")).first()
    return row.d if row else 0


def fit_list(vectors: DataFrame) -> DataFrame:
    return stored(vectors.select("x").distinct(), "distinct-vectors")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def sums_of(fit: DataFrame, d: int) -> tuple[int, list[int], int]:
    """Number of rows, exact sum of each entry, and the largest magnitude."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, most = 0, np.zeros(d, object), 0
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            total += x.astype(object).sum(axis=0) if _magnitude(x) > 1 << 40 else x.sum(axis=0)
            most = max(most, _magnitude(x))
        if n:
            out = [list(range(d)), list(map(str, total)), [n] * d, [str(most)] * d]
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["i", "s", "n", "most"])

    whole = lambda c: F.col(c).cast("decimal(38,0)")
    parts = fit.select("x").mapInArrow(run, "i int, s string, n bigint, most string")
    added = parts.groupBy("i").agg(F.sum(whole("s")).alias("s"), F.sum("n").alias("n"), F.max(whole("most")).alias("most"))
    rows = added.orderBy("i").collect()  # d rows
    return rows[0].n, [int(r.s) for r in rows], int(rows[0].most)


def _magnitude(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


@dataclass(frozen=True)
class Centre:
    """How rows are centred: exactly, in 64-bit integers where these are known to do."""

    n: int
    sums: list[int]
    most: int

    @property
    def _narrow(self) -> bool:
        return self.n * self.most + max(map(abs, self.sums)) < 1 << 62

    def exact(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``; ``most`` bounds the fitted rows, and every row is fitted."""
        if self._narrow:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        exact = self.exact(x)
        most = max(abs(int(exact.max(initial=0))), abs(int(exact.min(initial=0))))
        if most * most * max(1, x.shape[1]) < 1 << 63:
            return (exact * exact).sum(axis=1).tolist()
        wide = exact.astype(object)
        return [v if v < 1 << 63 else None for v in (wide * wide).sum(axis=1)]


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``Q`` with ``Q R = rows``, by substitution column after column."""
    out = np.empty_like(rows)
    for j in range(factor.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def gram(fit: DataFrame, centre: Centre, step: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Products of all pairs of columns of the rows after ``step``; a last column of ones adds their sums."""
    d = len(centre.sums)
    size = width + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            rows = step(centre.rows(_matrix(batch.column(0), d)))
            rows = np.column_stack([rows, np.ones(len(rows))])
            total += rows.T @ rows
        cells = [np.repeat(np.arange(size), size), np.tile(np.arange(size), size), total.ravel()]
        kinds = (pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cells, kinds, strict=True)], ["i", "j", "v"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, v double")
    added = stored(parts.groupBy("i", "j").agg(F.sum("v").alias("v")), "gram")
    out = np.zeros((size, size))
    cells = added.toPandas()  # (d + 1)^2 rows
    out[cells.i, cells.j] = cells.v
    forget(added)
    return out


def _factor(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor. Where rounding leaves no factor, the least shift that gives one is taken."""
    least = len(g) * UNIT * max(float(np.trace(g)), np.finfo(float).tiny)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(least, 10 * shift)


def orthogonalise(fit: DataFrame, centre: Centre) -> np.ndarray:
    """``R`` of ``C = Q R``; zero if all rows are equal."""
    d = len(centre.sums)
    factors: list[np.ndarray] = []
    whole = np.eye(d)

    for turn in range(MOST_PASSES):

        def through(rows: np.ndarray, known: tuple = tuple(factors)) -> np.ndarray:
            for factor in known:
                rows = solved(rows, factor)
            return rows

        g = gram(fit, centre, through, d)[:d, :d]
        if turn == 0 and not g.any():
            return np.zeros((d, d))
        if np.abs(g - np.eye(d)).max() <= 8 * d * UNIT and turn:
            break
        shift = 0.0 if turn else 11 * (centre.n * d + d * (d + 1)) * UNIT * float(np.trace(g))
        factors.append(_factor(g, shift))
        whole = factors[-1] @ whole
    return whole


@dataclass(frozen=True)
class Whitening:
    """Components as columns, and what they explain; ``scales`` has zeros for those without direction."""

    centre: Centre
    components: np.ndarray
    scales: np.ndarray
    explained: np.ndarray

    def apply(self, rows: np.ndarray) -> np.ndarray:
        return (rows @ self.components) * self.scales


def fit(vectors: DataFrame, d: int, k: int) -> tuple[Whitening, float]:
    """The first ``k`` components of ``d``-long vectors, and how far their covariance is from the identity."""
    distinct = fit_list(vectors)
    centre = Centre(*sums_of(distinct, d))
    _, sigma, rows = np.linalg.svd(orthogonalise(distinct, centre))
    k = min(k, d)
    directed = sigma[:k] > ROUNDING * sigma[0]
    variance = np.where(directed, sigma[:k] ** 2 / centre.n, 0)
    signs = np.sign(rows[np.arange(k), np.abs(rows[:k]).argmax(axis=1)])
    scales = np.divide(1, np.sqrt(variance), out=np.zeros(k), where=directed)
    trace = float((sigma**2).sum()) / centre.n
    found = Whitening(centre, (rows[:k] * signs[:, None]).T, scales, variance / trace if trace else variance)
    sums = gram(distinct, centre, found.apply, k) / centre.n
    covariance = sums[:k, :k] - np.outer(sums[k, :k], sums[k, :k])
    forget(distinct)
    return found, float(np.abs(covariance - np.eye(k))[directed][:, directed].max(initial=0))


def whiten(rows: DataFrame, k: int = 4, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    vectors = whole_vectors(rows, vec_id, embedding)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    d = usual_length(vectors)
    if not d:
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, {OUT}")
    vectors = vectors.filter(F.size("x") == d)
    found, error = fit(vectors, d, k)
    width = len(found.scales)
    names = ["vec_id", *(part.split()[0] for part in OUT.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            each = np.repeat(np.arange(len(x)), width)
            values = found.apply(found.centre.rows(x))
            arrays = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, width + 1), len(x)), pa.int32()),
                pa.array(np.full(len(each), found.centre.n), pa.int64()),
                pa.array(found.centre.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(values.ravel(), pa.float64(), mask=np.tile(found.scales == 0, len(x))),
                pa.array(np.tile(found.explained, len(x)), pa.float64()),
                pa.array(np.full(len(each), error), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return vectors.mapInArrow(run, f"vec_id {kind}, {OUT}")
