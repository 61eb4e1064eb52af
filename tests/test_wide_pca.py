"""Components of wide sparse rows against NumPy."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyglint.operators import projection as pj
from polyglint.operators import wide_pca as wp

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", VectorUDT())])


def _topics(n=400, width=1500, topics=6, seed=3):
    """Sparse rows about a few topics of their own columns, with falling weight."""
    rng = np.random.default_rng(seed)
    dense = np.zeros((n, width))
    for i in range(n):
        topic = rng.integers(topics)
        at = topic * 200 + rng.choice(40, 12, replace=False)
        dense[i, at] = (topics - topic) * (1 + rng.random(12))
        dense[i, rng.choice(width, 5, replace=False)] += 0.1 * rng.random(5)
    return dense


def _frame(spark, dense, sparse=True):
    rows = []
    for i, row in enumerate(dense):
        at = np.flatnonzero(row)
        rows.append((i, Vectors.sparse(len(row), at.tolist(), row[at].tolist()) if sparse else Vectors.dense(row)))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def _exact(dense, k):
    centred = dense - dense.mean(axis=0)
    _, sizes, right = np.linalg.svd(centred, full_matrices=False)
    return (sizes**2 / (len(dense) - 1))[:k], right[:k].T


def test_leading_components_equal_svd(spark):
    dense = _topics()
    variances, axes = _exact(dense, 4)
    fitted = wp.fit_wide_pca(_frame(spark, dense), "v", k=4, tol=1e-9)
    assert fitted.variances == pytest.approx(variances, rel=1e-5)
    assert fitted.total == pytest.approx(dense.var(axis=0, ddof=1).sum())
    assert np.abs((fitted.components * axes).sum(axis=0)) == pytest.approx(np.ones(4), abs=1e-4)
    assert fitted.residuals.max() < 1e-2 and 1 < fitted.passes <= 30
    coords = fitted.transform(_frame(spark, dense)).orderBy("id").toPandas().coords
    want = (dense - dense.mean(axis=0)) @ fitted.components
    assert np.allclose(np.stack(coords), want)
    peaks = fitted.components[np.abs(fitted.components).argmax(axis=0), range(4)]
    assert (peaks > 0).all()


def test_more_passes_hold_no_less_variance_and_never_more_than_exact(spark):
    dense = np.random.default_rng(1).random((150, 300)) * (np.random.default_rng(2).random((150, 300)) < 0.1)
    exact = _exact(dense, 20)[0].sum()
    frame = _frame(spark, dense)
    held = [wp.fit_wide_pca(frame, "v", k=20, passes=p, tol=0.0).variances.sum() for p in (1, 3, 12)]
    assert held[0] < held[1] < held[2] <= exact * (1 + 1e-12)
    assert held[2] > 0.99 * exact


def test_narrow_dense_rows_are_exact_in_one_pass(spark):
    dense = np.random.default_rng(4).standard_normal((200, 12)) * np.arange(12, 0, -1)
    frame = _frame(spark, dense, sparse=False)
    fitted, covariance = wp.fit_wide_pca(frame, "v", k=5), pj.fit_pca(frame, "v", 5)
    assert fitted.passes == 1 and fitted.residuals.max() < 1e-9
    assert fitted.explained == pytest.approx(covariance.explained)
    ours = np.stack(fitted.transform(frame).orderBy("id").toPandas().coords)
    theirs = np.stack(covariance.transform(frame).orderBy("id").toPandas().coords)
    assert np.allclose(ours, theirs)


def test_parts_hold_all_cells_within_the_bound(monkeypatch):
    monkeypatch.setattr(wp, "HELD_CELLS", 60)
    rng = np.random.default_rng(5)
    lengths = rng.integers(0, 9, 50)
    lengths[7] = 100
    indices = np.concatenate([rng.choice(200, m, replace=False) for m in lengths])
    values = rng.random(len(indices))
    whole, seen = np.zeros((50, 200)), 0
    for rows, columns, cells in wp._dense_parts(indices, values, lengths):
        for at, row in zip(range(rows.start, rows.stop), cells):
            whole[at, columns] = row
        assert cells.size <= 60 or rows.stop - rows.start == 1
        seen += rows.stop - rows.start
    want = np.zeros((50, 200))
    want[np.repeat(np.arange(50), lengths), indices] = values
    assert seen == 50 and np.array_equal(whole, want)


def test_nulls_empty_tables_and_constant_rows(spark):
    rows = [(1, Vectors.sparse(3000, [5], [2.0])), (2, None), (3, Vectors.sparse(3000, [], [])), (4, Vectors.sparse(3000, [9], [1.0]))]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("indices", F.lit("kept"))
    fitted = wp.fit_wide_pca(frame, "v", k=2)
    got = {r.id: r.coords for r in fitted.transform(frame).collect()}
    assert got[2] is None and all(len(got[i]) == 2 for i in (1, 3, 4))
    assert sum(fitted.explained) == pytest.approx(1)
    assert fitted.transform(frame).columns == ["id", "v", "indices", "coords"]

    empty = spark.createDataFrame([], SCHEMA)
    none = wp.fit_wide_pca(empty, "v", k=2)
    assert none.explained == [] and none.transform(empty).count() == 0
    same = spark.createDataFrame([(i, Vectors.sparse(2000, [3], [1.0])) for i in range(3)], SCHEMA)
    flat = wp.fit_wide_pca(same, "v", k=2)
    assert flat.explained == [0.0, 0.0]
    assert {tuple(r.coords) for r in flat.transform(same).collect()} == {(0.0, 0.0)}


def test_wide_vectors_are_reduced_without_a_covariance(spark, monkeypatch):
    monkeypatch.setattr(pj, "fit_pca", None)
    dense = _topics(n=60)
    reduced = pj.pre_reduce(_frame(spark, dense), "v", width=1500, k=5)
    assert {len(r.reduced) for r in reduced.collect()} == {5}


def test_close_variances_are_told_apart_as_exactly_as_by_a_covariance(spark):
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    variances = np.linspace(1.0, 0.98, 64)
    dense = (turn * np.sqrt(variances)).T
    dense = np.vstack([dense, -dense])
    found = wp.fit_wide_pca(_frame(spark, dense, sparse=False), "v", 2, extra=60, tol=1e-12)
    assert np.abs(np.abs(np.sum(found.components * turn[:, :2], axis=0)) - 1).max() < 1e-9
    assert found.passes <= 3
