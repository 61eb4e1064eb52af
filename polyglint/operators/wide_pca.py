"""Principal components of wide, mostly empty rows by a randomised range finder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Cells of rows that a task makes dense at once, on the columns they fill only (32 MB).
HELD_CELLS, HELD_ROWS = 1 << 22, 256
#: Columns whose sums travel as one row: 250 KB at 60 directions.
BLOCK = 512
#: Blocks of directions that the driver keeps, with their products (31 MB at 8,000 x 60).
MOST_BLOCKS = 4


# --- within a task ----------------------------------------------------------------------------


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of an Arrow list column end to end, and the length of each list (null: none)."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def _dense_parts(
    indices: np.ndarray, values: np.ndarray, lengths: np.ndarray
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, columns, cells): a few rows at a time, dense on the columns that they fill.

    A part ends before its cells, at most rows times values, pass HELD_CELLS; one row alone may
    hold more than that, which is its own size.
    """
    ends = np.cumsum(lengths)
    starts = ends - lengths
    row = 0
    while row < len(lengths):
        last = min(row + HELD_ROWS, len(lengths))
        while last > row + 1 and (last - row) * (ends[last - 1] - starts[row]) > HELD_CELLS:
            last = row + (last - row) // 2
        inside = slice(starts[row], ends[last - 1])
        columns, place = np.unique(indices[inside], return_inverse=True)
        cells = np.zeros((last - row, len(columns)))
        cells[np.repeat(np.arange(last - row), lengths[row:last]), place] = values[inside]
        yield slice(row, last), columns, cells
        row = last


def _projected(indices: pa.Array, values: pa.Array, directions: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Centred coordinates of each row: its product with the directions less that of the mean."""
    at, lengths = _flat(indices)
    out = np.empty((len(lengths), directions.shape[1]))
    for rows, columns, cells in _dense_parts(at, _flat(values)[0], lengths):
        out[rows] = cells @ directions[columns] - shift
    return out


# --- one pass over the rows -------------------------------------------------------------------


def _cells(vec: str) -> list[Column]:
    """Indices and values of a vector column, sparse or dense, without filling in zeros."""
    plain = F.unwrap_udt(F.col(vec))
    every = F.sequence(F.lit(0), F.size(plain["values"]) - 1)
    filled = F.when(F.size(plain["values"]) > 0, every).otherwise(F.array().cast("array<int>"))
    return [F.coalesce(plain["indices"], filled).alias("indices"), plain["values"].alias("values")]


def _scatter(rows: DataFrame, mean: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The centred rows' scatter matrix times ``directions``, by one pass over the rows.

    Each task adds its rows up in one width x directions array and hands on its filled blocks of
    columns; a block is added up where it is shuffled to, and only the sum reaches the driver.
    """
    width, many = directions.shape
    shift = mean @ directions
    sent = rows.sparkSession.sparkContext.broadcast(directions)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, filled = np.zeros((width, many)), np.zeros(-(-width // BLOCK), bool)
        for batch in batches:
            at, lengths = _flat(batch.column("indices"))
            for _, columns, cells in _dense_parts(at, _flat(batch.column("values"))[0], lengths):
                total[columns] += cells.T @ (cells @ sent.value[columns] - shift)
                filled[columns // BLOCK] = True
        yield from _blocks(np.flatnonzero(filled), lambda b: total[b * BLOCK:(b + 1) * BLOCK])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column("block").to_pylist(), batch.column("sums")):
                part = np.frombuffer(part.as_buffer())
                sums[block] = sums[block] + part if block in sums else part.copy()
        yield from _blocks(sorted(sums), sums.__getitem__)

    kind = "block int, sums binary"
    partial = rows.mapInArrow(products, kind).repartition("block").mapInArrow(added, kind)
    out = np.zeros((width, many))
    for block, part in partial.toLocalIterator():
        out[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(part).reshape(-1, many)
    sent.unpersist()
    return out


def _blocks(blocks, sums_of) -> Iterator[pa.RecordBatch]:
    for block in blocks:
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array([block], pa.int32()), "sums": pa.array([sums_of(block).tobytes()], pa.binary())}
        )


# --- fitting ------------------------------------------------------------------------------------


class WideProjection:
    """Components found, the share of the variance each explains, and how exact they are.

    ``residuals`` holds |S v - lambda v| / lambda for each component v of the covariance S;
    ``passes`` counts the passes over the rows.
    """

    def __init__(self, vec: str, mean: np.ndarray, components: np.ndarray, variances: np.ndarray, total: float,
                 residuals: np.ndarray, passes: int):
        self._vec, self._mean, self.components = vec, mean, components
        self.variances, self.total, self.residuals, self.passes = variances, total, residuals, passes
        self.explained = list(variances / total) if total > 0 else [0.0] * len(variances)

    def transform(self, df: DataFrame, out: str = "coords") -> DataFrame:
        """Add the centred coordinates as an array of doubles; a null vector has null."""
        sent = df.sparkSession.sparkContext.broadcast(self.components)
        shift = self._mean @ self.components

        @F.arrow_udf("array<double>")
        def project(indices: pa.Array, values: pa.Array) -> pa.Array:
            found = _projected(indices, values, sent.value, shift)
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
            return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))

        return df.withColumn(out, F.when(F.col(self._vec).isNotNull(), project(*_cells(self._vec))))


def fit_wide_pca(
    df: DataFrame, vec: str, k: int = 50, extra: int = 10, passes: int = 30, tol: float = 1e-4, seed: int = 42,
) -> WideProjection:
    """The ``k`` leading principal components of a vector column of any width.

    A random block of k + ``extra`` directions is multiplied by the covariance, one pass over the
    rows. What the product holds outside the directions met so far is the next block (block
    Lanczos), until the variance of the best k grows by less than ``tol`` of itself or after
    ``passes``. Beyond MOST_BLOCKS blocks the directions are cut to the leading k + extra found.
    The covariance itself is never formed: a task holds width x (k + extra) numbers, the driver
    2 * MOST_BLOCKS times as many, and rows stay sparse. Where the directions span all columns
    the result is exact, however close the variances lie.

    Null vectors are left out. With fewer than two rows nothing varies: all variances are 0.
    There are at most as many components as columns. Each component's largest loading is
    positive, the first of equal ones.
    """
    known = df.where(F.col(vec).isNotNull())
    if known.isEmpty():  # the summariser refuses to summarise nothing
        return WideProjection(vec, np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0, np.zeros(0), 0)
    moments = known.agg(Summarizer.metrics("count", "mean", "variance").summary(F.col(vec)).alias("m")).first().m
    mean, n = moments["mean"].toArray(), moments["count"]
    total, width = float(moments["variance"].toArray().sum()), len(mean)
    k, many = min(k, width), min(k + extra, width)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, many)))[0]
    if n < 2 or total <= 0:
        return WideProjection(vec, mean, _signed(block[:, :k]), np.zeros(k), 0.0, np.zeros(k), 0)

    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    rows = cut_lineage(known.select(*_cells(vec))).coalesce(tasks)  # one sum a task, not one a file
    basis, images = np.zeros((width, 0)), np.zeros((width, 0))
    held, done = 0.0, 0
    while True:
        moved, done = _scatter(rows, mean, block) / (n - 1), done + 1
        basis, images = np.hstack([basis, block]), np.hstack([images, moved])
        inner = basis.T @ images
        variances, turn = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-variances, kind="stable")
        lead, best = order[:many], order[:k]
        kept = np.maximum(variances[best], 0.0)
        if basis.shape[1] == width or done >= passes or kept.sum() - held <= tol * kept.sum():
            break
        missed = images @ turn[:, lead] - basis @ (turn[:, lead] * variances[lead])
        block = _outside(missed, basis, kept[0])
        if not block.shape[1]:
            break
        held = kept.sum()
        if basis.shape[1] + block.shape[1] > MOST_BLOCKS * many:
            basis, images = basis @ turn[:, lead], images @ turn[:, lead]
    components, variances = basis @ turn[:, best], kept
    missed = np.linalg.norm(images @ turn[:, best] - components * variances, axis=0)
    residuals = missed / np.maximum(variances, np.finfo(float).tiny)
    return WideProjection(vec, mean, _signed(components), variances, total, residuals, done)


def _outside(found: np.ndarray, basis: np.ndarray, scale: float) -> np.ndarray:
    """An orthonormal basis of what ``found`` holds outside ``basis``, rounding left out."""
    for _ in range(2):  # once more, as the first difference loses digits
        found = found - basis @ (basis.T @ found)
    left, size, _ = np.linalg.svd(found, full_matrices=False)
    most = basis.shape[0] - basis.shape[1]
    left = left[:, size > 1e-13 * scale][:, :most]
    return np.linalg.qr(left - basis @ (basis.T @ left))[0]


def _signed(components: np.ndarray) -> np.ndarray:
    peaks = components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])]
    return components * np.where(peaks < 0, -1.0, 1.0)
