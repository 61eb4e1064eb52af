"""Linear support vector machines with the squared hinge loss, by truncated Newton steps."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Bytes of a block of rows, and the step lengths tried along a direction.
BLOCK_BYTES, STEPS = 1 << 22, tuple(2.0**-k for k in range(16))


def _dense(df: DataFrame, name: str) -> Column:
    x = F.col(name) if df.schema[name].dataType.typeName() == "array" else vector_to_array(name)
    return F.transform(x, lambda v: v.cast("double"))


def _state(block, weights: np.ndarray, c: float) -> tuple[np.ndarray, np.ndarray]:
    """By class: the losses' pull on the weights, and the loss, the sum and the squares of the dual
    variables that the weights imply."""
    x, signs, counts = block
    short = np.maximum(1 - signs * (x @ weights.T), 0)
    alpha = 2 * c * short
    return (counts[:, None] * alpha * signs).T @ x, np.stack([c * (counts @ short**2), counts @ alpha, counts @ alpha**2])


def _curved(block, weights: np.ndarray, along: np.ndarray, c: float) -> np.ndarray:
    """The losses' curvature along a direction of each class."""
    x, signs, counts = block
    held = signs * (x @ weights.T) < 1
    return (2 * c * counts[:, None] * held * (x @ along.T)).T @ x


def _tried(block, weights: np.ndarray, along: np.ndarray, c: float) -> np.ndarray:
    """Losses by step length and class."""
    x, signs, counts = block
    here, more = signs * (x @ weights.T), signs * (x @ along.T)
    return np.stack([c * (counts @ np.maximum(1 - here - s * more, 0) ** 2) for s in STEPS])


def _pair(a, b):
    return a[0] + b[0], a[1] + b[1]


@dataclass
class SquaredHingeSvm:
    """One machine against the rest for each class 0 to n - 1, an intercept included.

    Newton's directions come from conjugate gradients, each of which is one job that adds up the
    curvature along a direction for all classes; nothing wider than the weights leaves a task.
    The weights imply dual variables, so the duality gap says how far from the optimum they can be
    at most: it ends when that falls under ``gap`` of the loss for every class, or after ``rounds``.
    """

    c: float = 1.0
    rounds: int = 100
    gap: float = 1e-3
    directions: int = 20
    features: str = "features"
    label: str = "label"

    def fit(self, df: DataFrame) -> SvmModel:
        """Rows without a label or features aren't learnt from; no rows are an error."""
        rows = df.select(_dense(df, self.features).alias("x"), F.col(self.label).cast("int").alias("label"))
        rows = rows.where("x is not null and label is not null")
        head = rows.agg(F.max("label"), F.max(F.size("x")), F.count(F.lit(1))).first()
        if not head[2]:
            raise ValueError("no rows to learn from")
        classes, width, c = int(head[0]) + 1, int(head[1]) + 1, self.c
        blocks = self._blocks(rows, classes, width).persist(StorageLevel.MEMORY_AND_DISK)
        weights = np.zeros((classes, width))
        model = SvmModel(self, weights)
        for _ in range(self.rounds):
            pull, (loss, alpha, square) = blocks.map(lambda b, w=weights: _state(b, w, c)).treeReduce(_pair)
            primal = (weights**2).sum(axis=1) / 2 + loss
            # the best multiple of the dual variables
            bend = (pull**2).sum(axis=1) + square / (2 * c)
            dual = np.divide(alpha**2, 2 * bend, out=np.zeros(classes), where=bend > 0)
            gaps = (primal - dual) / np.maximum(primal, 1e-12)
            model.gaps.append(float(gaps.max()))
            if model.gaps[-1] < self.gap:
                break
            along = self._direction(blocks, weights, weights - pull)
            losses = blocks.map(lambda b, w=weights, d=along: _tried(b, w, d, c)).treeReduce(np.add)
            whole = losses + np.stack([((weights + s * along) ** 2).sum(axis=1) / 2 for s in STEPS])
            best = np.where(whole.min(axis=0) < primal, np.array(STEPS)[whole.argmin(axis=0)], 0.0)
            weights = model.weights = weights + best[:, None] * along
        blocks.unpersist()
        return model

    def _direction(self, blocks, weights: np.ndarray, slope: np.ndarray) -> np.ndarray:
        """Conjugate gradients for all classes at once, each until its remainder is a tenth."""
        out, rest, c = np.zeros_like(slope), -slope, self.c
        along, size = rest.copy(), (rest**2).sum(axis=1)
        enough = 0.01 * size
        for _ in range(self.directions):
            open_ = size > enough
            if not open_.any():
                break
            bent = along + blocks.map(lambda b, w=weights, d=along: _curved(b, w, d, c)).treeReduce(np.add)
            length = np.where(open_, size / np.maximum((along * bent).sum(axis=1), 1e-300), 0.0)[:, None]
            out, rest = out + length * along, rest - length * bent
            new = np.where(open_, (rest**2).sum(axis=1), size)
            along = np.where(open_[:, None], rest + (new / np.maximum(size, 1e-300))[:, None] * along, along)
            size = new
        return out

    @staticmethod
    def _blocks(rows: DataFrame, classes: int, width: int):
        """Equal rows add the same to every sum, so they are one row with a count; what is left lies
        in a partition for every BLOCK_BYTES or so."""
        most = max(64, BLOCK_BYTES // (8 * width))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, most):
                    part = batch.slice(start, most)
                    x = np.stack(part.column("x").to_numpy(zero_copy_only=False))
                    yield pa.record_batch([
                        pa.array([x.tobytes()], pa.binary()),
                        *[pa.array([part.column(c).to_numpy().astype(np.int64).tobytes()], pa.binary()) for c in ("label", "count")],
                    ], ["x", "labels", "counts"])

        def opened(row):
            labels = np.frombuffer(row[1], np.int64)
            x = np.frombuffer(row[0]).reshape(len(labels), -1)
            signs = np.where(labels[:, None] == np.arange(classes), 1.0, -1.0)
            return np.hstack([x, np.ones((len(x), 1))]), signs, np.frombuffer(row[2], np.int64).astype(np.float64)

        kinds = cut_lineage(rows.groupBy("x", "label").count())
        parts = math.ceil(kinds.count() * 8 * (width + classes + 1) / BLOCK_BYTES)
        return kinds.coalesce(max(1, parts)).mapInArrow(run, "x binary, labels binary, counts binary").rdd.map(opened)


@dataclass
class SvmModel:
    settings: SquaredHingeSvm
    weights: np.ndarray  # by class, the intercept last
    #: largest relative duality gap of any class, round by round
    gaps: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``rawPrediction``, a margin for each class, and ``prediction``; null without features."""
        rows = F.array(*[F.array(*[F.lit(float(v)) for v in w[:-1]]) for w in self.weights])
        ends = F.array(*[F.lit(float(w[-1])) for w in self.weights])
        x = df.withColumn("_x", _dense(df, self.settings.features)).withColumn("_w", rows)

        def margin(w: Column, end: Column) -> Column:
            return F.aggregate(F.zip_with("_x", w, lambda a, b: a * b), end, lambda total, v: total + v)

        margins = F.when(F.col("_x").isNotNull(), F.zip_with("_w", ends, margin))
        out = x.withColumn("_m", margins)
        raw = F.when(F.col("_m").isNotNull(), array_to_vector(F.coalesce("_m", F.array(F.lit(0.0)))))
        best = (F.array_position("_m", F.array_max("_m")) - 1).cast("double")
        return out.withColumn("rawPrediction", raw).withColumn("prediction", best).drop("_x", "_w", "_m")
