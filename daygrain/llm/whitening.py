"""Whitening of embeddings by shifted CholeskyQR: Gram passes over the rows, small factors on the driver."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.session import written

SLICE = 1 << 20  # numbers a task works on at once
UNIT = 2.0**-53
PASSES = 12
STRAIGHT = 1e-12  # singular values of the rows that are left are so near to 1
LEAST = 1e-12  # of the largest singular value, for each square root of the width: below it there is only rounding
LARGEST = float(1 << 61)  # an entry beyond it has no whole number of 64 bits


@dataclass
class Fit:
    """What the passes know about the vectors of one width."""

    n: int
    sums: list[int]
    factors: list[np.ndarray] = field(default_factory=list)  # upper triangular, the first pass first
    rank: int | None = None  # directions that have variance
    components: np.ndarray | None = None  # a component a column
    values: np.ndarray | None = None  # their eigenvalues
    explained: np.ndarray | None = None
    identity_error: float = 0.0

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)  # sums = n * whole + rest, 0 <= rest < n
        self.rest = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """Rows minus their mean; the whole part is taken off in integers, so large entries lose nothing."""
        return (rows - self.whole).astype(np.float64) - self.rest / self.n

    def orthogonal(self, rows: np.ndarray) -> np.ndarray:
        """Centred rows after a triangular solve with each factor so far."""
        out = self.centred(rows)
        for factor in self.factors:
            out = solved(out, factor)
        return out

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ (self.components / np.sqrt(self.values))

    def deviations(self, rows: np.ndarray) -> list[int]:
        """Exact sums of (n * x - S)^2 over each row's dimensions."""
        far = rows - self.whole
        bound = (float(np.abs(far).max(initial=0)) + 1) * self.n
        if bound * bound * max(1, rows.shape[1]) < 2.0**62:
            apart = far * self.n - self.rest
            return (apart * apart).sum(axis=1).tolist()
        rest = self.rest.tolist()
        return [sum((a * self.n - b) ** 2 for a, b in zip(row, rest)) for row in far.tolist()]


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows @ inverse(factor) by forward substitution over the columns, in blocks."""
    out = np.array(rows, order="F")
    width, step = factor.shape[0], 32
    for a in range(0, width, step):
        b = min(a + step, width)
        if a:
            out[:, a:b] -= out[:, :a] @ factor[:a, a:b]
        for j in range(a, b):
            if j > a:
                out[:, j] -= out[:, a:j] @ factor[a:j, j]
            out[:, j] /= factor[j, j]
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of rows of one width, bounded in numbers."""
    widths = batch.column("width").to_numpy(zero_copy_only=False)
    for width in np.unique(widths).tolist():
        own = batch if (widths == width).all() else batch.take(pa.array(np.flatnonzero(widths == width)))
        step = max(1, SLICE // max(1, width))
        for i in range(0, own.num_rows, step):
            yield width, own.slice(i, step)


def _grams(fits: dict[int, Fit], whiten: bool):
    """Each task's Gram matrices, a row of a matrix a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, part in _by_width(batch):
                rows, fit = _matrix(part.column("x"), width), fits[width]
                rows = fit.whitened(rows) if whiten else fit.orthogonal(rows)
                gram = rows.T @ rows
                sums[width] = sums[width] + gram if width in sums else gram
        for width, gram in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(gram), width, np.int32)), pa.array(np.arange(len(gram), dtype=np.int32)),
                    pa.array(list(gram), pa.list_(pa.float64())),
                ],
                ["width", "line", "numbers"],
            )

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's rows and sums by dimension; the upper and lower bits apart, so no sum overflows."""
    counts: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for width, part in _by_width(batch):
            rows = _matrix(part.column("x"), width)
            own = np.stack([(rows >> 31).sum(axis=0), (rows & 0x7FFFFFFF).sum(axis=0)])
            counts[width] = counts.get(width, 0) + len(rows)
            sums[width] = sums[width] + own if width in sums else own
    for width, own in sums.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(width, width, np.int32)), pa.array(np.arange(width, dtype=np.int32)),
                pa.array(np.full(width, counts[width])), pa.array(own[0]), pa.array(own[1]),
            ],
            ["width", "i", "n", "upper", "lower"],
        )


def _summed(table: pa.Table) -> pa.Table:
    numbers = table.column("numbers").combine_chunks()
    total = _matrix(numbers, len(numbers[0])).sum(axis=0)
    return pa.table({
        "width": table.column("width").slice(0, 1), "line": table.column("line").slice(0, 1), "numbers": pa.array([total], pa.list_(pa.float64())),
    })


def gram(rows: DataFrame, fits: dict[int, Fit], whiten: bool = False) -> dict[int, np.ndarray]:
    """The Gram matrix of each width: a matrix a task, summed by line in Spark; the driver sees width^2 numbers."""
    kind = "width int, line int, numbers array<double>"
    lines = rows.select("width", "x").mapInArrow(_grams(fits, whiten), kind).groupBy("width", "line").applyInArrow(_summed, kind)
    sizes = {w: len(f.values) if whiten else w for w, f in fits.items()}
    out = {w: np.zeros((n, n)) for w, n in sizes.items()}
    for line in lines.collect():
        out[line["width"]][line["line"]] = line["numbers"]
    return out


def shifted_factor(matrix: np.ndarray, n: int) -> np.ndarray:
    """The upper Cholesky factor; a matrix that is not safely positive definite is shifted first."""
    width = len(matrix)
    values = np.linalg.eigvalsh(matrix)
    shift = 0.0
    if values[0] <= 1e-8 * values[-1]:
        shift = max(11 * (n * width + width * (width + 1)) * UNIT, 1e-15) * values[-1]
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * np.eye(width)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 1e-15 * values[-1])


def _settled(matrix: np.ndarray) -> int | None:
    """How many directions of the rows have length 1, if all others have none."""
    values = np.linalg.eigvalsh(matrix)
    straight = np.abs(values - 1) <= STRAIGHT * len(values)
    return int(straight.sum()) if np.all(straight | (values < 1e-10)) else None


def _decomposed(fit: Fit, components: int) -> None:
    """SVD of the composed factor: right singular vectors are components, squares over n their eigenvalues."""
    whole = np.eye(len(fit.sums))
    for factor in fit.factors:
        whole = factor @ whole
    _, sizes, turned = np.linalg.svd(whole)
    values = sizes * sizes / fit.n
    sound = int((sizes > sizes[0] * math.sqrt(len(sizes)) * LEAST).sum()) if len(sizes) and sizes[0] > 0 else 0
    sound = sound if fit.rank is None else min(sound, fit.rank)
    kept = turned[:min(sound, components)].T
    heads = np.abs(kept).argmax(axis=0)
    fit.components = kept * np.where(kept[heads, np.arange(kept.shape[1])] < 0, -1.0, 1.0)
    fit.values = values[:fit.components.shape[1]]
    fit.explained = fit.values / values[:max(sound, 1)].sum() if sound else fit.values


def fitted(rows: DataFrame, components: int) -> dict[int, Fit]:
    """Fits of all widths from the distinct rows (width, x): sums, Gram passes until the rows are orthonormal, SVD."""
    wide = (F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "upper", "lower"))
    total = rows.select("width", "x").mapInArrow(_totals, "width int, i int, n long, upper long, lower long").groupBy("width", "i").agg(*wide).collect()
    fits = {}
    for width in sorted({r["width"] for r in total}):
        own = sorted((r["i"], int(r["n"]), (int(r["upper"]) << 31) + int(r["lower"])) for r in total if r["width"] == width)
        fits[width] = Fit(own[0][1], [s for _, _, s in own])
    open_fits = dict(fits)
    for _ in range(PASSES):
        if not open_fits:
            break
        here = rows.where(F.col("width").isin(*open_fits))
        for width, matrix in gram(here, open_fits).items():
            fit = fits[width]
            fit.rank = _settled(matrix) if fit.factors else None
            if not matrix.any() or fit.rank is not None:
                del open_fits[width]
            else:
                fit.factors.append(shifted_factor(matrix, fit.n))
    for fit in fits.values():
        if fit.factors:
            _decomposed(fit, components)
        else:  # all rows are equal
            fit.components, fit.values, fit.explained = np.zeros((len(fit.sums), 0)), np.zeros(0), np.zeros(0)
    fits = {w: f for w, f in fits.items() if len(f.values)}
    if fits:
        for width, matrix in gram(rows.where(F.col("width").isin(*fits)), fits, whiten=True).items():
            fits[width].identity_error = float(np.abs(matrix / fits[width].n - np.eye(len(matrix))).max())
    return fits


def _projected(fits: dict[int, Fit], carried: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, part in _by_width(batch):
                fit, rows = fits[width], _matrix(part.column("x"), width)
                white, k, m = fit.whitened(rows), len(fit.values), len(rows)
                apart = pa.array(fit.deviations(rows), pa.decimal128(38, 0))
                at = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(carried).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, fit.n, np.int64)), apart.take(at), pa.array(white.reshape(-1)),
                        pa.array(np.tile(fit.explained, m)), pa.array(np.full(m * k, fit.identity_error)),
                    ],
                    [carried, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whole_numbers(vectors: DataFrame, scale: int, offset: int, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, width, x): floor(scale * c) + offset of every entry c; rows that have no such numbers are left out."""
    c = F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").alias(vec_id), c.alias("c")).where(
        F.col("c").isNotNull() & (F.size("c") > 0)
        & F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e * float(scale)) < LARGEST))
    )
    return rows.select(
        vec_id, F.size("c").alias("width"), F.transform("c", lambda e: F.floor(e * float(scale)) + F.lit(offset).cast("long")).alias("x")
    )


def whiten(
    vectors: DataFrame, components: int = 16, scale: int = 64, offset: int = 1_000_000, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """Whitened components of every vector (vec_id, embedding), fitted on the distinct vectors.

    Entries become whole numbers x = floor(scale * c) + offset.  Every distinct x vector enters the fit once; n, the sums
    S and so the deviation (sum over dimensions of (n * x - S)^2, decimal(38,0)) are exact.  Shifted CholeskyQR: each
    pass solves the centred rows with the factors so far, sums a Gram matrix a task, and factors it on the driver,
    with a shift while it is not safely positive definite, until the rows are orthonormal.  The composed factor has the
    rows' singular values, so small eigenvalues keep their digits; its SVD gives the components.  Only width^2 numbers
    reach the driver, and as many go to the tasks; each pass is narrow but for the sum.

    Returns vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained (share of the trace) and
    identity_error (largest absolute entry of the covariance of all whitened rows minus the identity; measured by
    a pass of its own).  A component's entry of largest size is positive.

    Defined results: vectors that are null, empty, or hold null or non-finite entries (or such that scale * c has no long) give
    no rows.  Vectors of each width are fitted on their own.  Components without variance (constant or dependent dimensions,
    fewer distinct vectors than dimensions) have no whitened value and are left out; so a width with a single distinct
    vector gives no rows, and an empty table none.  Repeated rows, equal or null vec_ids are answered row by row; other
    columns are not read.
    """
    rows = whole_numbers(vectors, scale, offset, vec_id, embedding)
    distinct = written(rows.select("width", "x").distinct(), "whole-vectors")
    fits = fitted(distinct, components)
    kind = dict(rows.dtypes)[vec_id]
    schema = f"`{vec_id}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not fits:
        return vectors.sparkSession.createDataFrame([], schema)
    return rows.where(F.col("width").isin(*fits)).mapInArrow(_projected(fits, vec_id), schema)
