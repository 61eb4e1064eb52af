"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import encoded, settle, slices

#: What is measured of a text, in the order of the vector.
STATISTICS = (
    "log_words", "log_word_chars", "symbols", "capitals", "digits", "marks", "stops", "blanks",
    "distinct_words", "compressed",
)
#: What ``_PRIOR_BYTES`` bytes of ordinary prose hold of symbols, capitals, digits, marks, stops
#: and blanks is added to each text, so that a short one isn't judged by a few characters.
_PRIOR_BYTES = 80.0
_PRIOR = np.array([0.002, 0.03, 0.02, 0.004, 0.02, 0.004])
_CLASSES = {
    "symbols": b"#*$%&|<>@\\^_~=+{}[]/", "digits": b"0123456789", "marks": b"!?;:\"'()-", "stops": b".,", "blanks": b"\n\t\r",
}


def _byte_tables() -> np.ndarray:
    tables = np.zeros((6, 256), np.float64)
    for row, name in enumerate(("symbols", "capitals", "digits", "marks", "stops", "blanks")):
        for b in _CLASSES.get(name, bytes(range(65, 91))):
            tables[row, b] = 1
    return tables


_TABLES = _byte_tables()


def statistics(column: pa.Array) -> np.ndarray:
    """A row of transformed statistics for each text: logarithms of counts and smoothed shares."""
    data, offsets = encoded(column)
    sizes = np.diff(offsets).astype(np.float64)
    raw = data.tobytes()
    out = np.zeros((len(sizes), len(STATISTICS)))
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        text = raw[a:b]
        words = text.split()
        n, size = len(words), float(b - a)
        counts = np.bincount(data[a:b], minlength=256)
        shares = (_TABLES @ counts + _PRIOR * _PRIOR_BYTES) / (size + _PRIOR_BYTES)
        capitals_beyond_ascii = len(text) - len(text.translate(None, b"\xc3")) if size else 0
        in_words = sum(map(len, words)) - capitals_beyond_ascii
        out[i, 0] = np.log1p(n)
        out[i, 1] = np.log((in_words + 50) / (n + 10))
        out[i, 2:8] = np.log(shares)
        out[i, 8] = np.log((len(set(words)) + 20) / (n + 20))
        out[i, 9] = np.log((len(zlib.compress(text, 1)) + 50) / (size + 100))
    return out


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of every whole text as an array; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4_000_000):
            rows = statistics(batch.column("text"))
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1])
            yield pa.record_batch(
                [batch.column("doc_id"), vectors.cast(pa.list_(pa.float64()))], ["doc_id", "x"]
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverses of the Cholesky factors and constants, computed once at fitting."""

    means: tuple[np.ndarray, np.ndarray]
    whiteners: tuple[np.ndarray, np.ndarray]
    constants: tuple[float, float]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the difference of the Gaussian log densities."""
        logs = []
        for mean, whitener, constant in zip(self.means, self.whiteners, self.constants):
            z = (x - mean) @ whitener.T
            logs.append(constant - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(rows: DataFrame, label: str = "label", shrinkage: float = 0.1) -> Discriminant | float:
    """Fit on rows of (x, label 0/1) with sums that Spark adds up: d * d + d + 1 cells a class.

    A class covariance is (1 - shrinkage) of its own and the rest of its diagonal, plus a small
    ridge. Without two rows in both classes there is no discriminant: the share of class 1 is
    returned instead (0.5 without any row).
    """
    d = len(STATISTICS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {0: np.zeros((d + 1, d + 1)), 1: np.zeros((d + 1, d + 1))}
        for batch in batches:
            labels = np.asarray(batch.column("label").to_numpy(zero_copy_only=False))
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, d)
            x = np.hstack([np.ones((len(x), 1)), x])
            for k in sums:
                own = x[labels == k]
                sums[k] += own.T @ own
        for k, total in sums.items():
            cells = np.arange(total.size)
            yield pa.record_batch(
                [pa.array(np.full(total.size, k)), pa.array(cells), pa.array(total.ravel())],
                ["label", "cell", "value"],
            )

    usable = rows.select(F.col(label).cast("int").alias("label"), "x").where(F.col("label").isin(0, 1))
    cells = usable.mapInArrow(add, "label long, cell long, value double").groupBy("label", "cell").agg(F.sum("value").alias("value"))
    sums = np.zeros((2, (d + 1) ** 2))
    for row in cells.collect():  # 2 * (d + 1) ** 2 cells, whatever the input
        sums[row["label"], row["cell"]] = row["value"]
    counts = sums[:, 0]
    if counts.min() < 2:
        return float(counts[1] / counts.sum()) if counts.sum() else 0.5
    means, whiteners, constants = [], [], []
    for k in (0, 1):
        total = sums[k].reshape(d + 1, d + 1)
        mean = total[0, 1:] / counts[k]
        cov = total[1:, 1:] / counts[k] - np.outer(mean, mean)
        spread = np.diag(np.diag(cov))
        cov = (1 - shrinkage) * cov + shrinkage * spread + 1e-4 * np.eye(d)
        factor = np.linalg.cholesky(cov)
        means.append(mean)
        whiteners.append(np.linalg.inv(factor))
        constants.append(float(np.log(counts[k] / counts.sum()) - np.log(np.diag(factor)).sum()))
    return Discriminant(tuple(means), tuple(whiteners), tuple(constants))


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """The fold never learnt from: crc32 of the id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 0, F.lit(False))


def learn(
    measured: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", shrinkage: float = 0.1
) -> Discriminant | float:
    """Fit on the measured rows that have a label and aren't in the held-out fold."""
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).alias("label"))
    known = known.where(F.col("label").isNotNull() & ~held_out("doc_id"))
    return fit(measured.join(known, "doc_id"), "label", shrinkage)


def probability(model: Discriminant | float, x: np.ndarray) -> np.ndarray:
    return np.full(len(x), model) if isinstance(model, float) else model.score(x)


def keep_good(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", threshold: float = 0.3, shrinkage: float = 0.1,
) -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts as class 1, with all their columns.

    Rows are measured again where they are read, which costs less than moving their texts.
    """
    model = learn(settle(measure(docs, doc_id, text), "statistics"), labels, doc_id, label, shrinkage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 4_000_000):
            yield batch.filter(pa.array(probability(model, statistics(batch.column(text))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def classify(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", threshold: float = 0.3, shrinkage: float = 0.1,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Statistics are measured once, written as a narrow table, joined with the labels outside the
    held-out fold (an id with several labels counts with each; null labels are ignored) for
    fitting, and scored. Every row is scored alone: repeated rows get the same score, a null or
    empty text has the statistics of no words, a null id is scored and never learnt from, an
    empty table gives no rows. Other columns of either table are not read.
    """
    measured = settle(measure(docs, doc_id, text), "statistics")
    model = learn(measured, labels, doc_id, label, shrinkage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(STATISTICS))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(probability(model, x))], ["doc_id", "score"]
            )

    scored = measured.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
