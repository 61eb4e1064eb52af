"""Support vector machines: the optimum, whatever the partitions, and what nulls do."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyglint.operators.newton_svm import SquaredHingeSvm

SCHEMA = "id long, features array<double>, label int"


@pytest.fixture
def data():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 5))
    y = np.argmax(x[:, :3] + 0.5 * rng.normal(size=(400, 3)), axis=1)
    return x, y


def table(spark, x, y):
    return spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))], SCHEMA)


def loss(w, x, y, c, cost):
    one = np.hstack([x, np.ones((len(x), 1))])
    short = np.maximum(1 - np.where(y == c, 1, -1) * (one @ w), 0)
    return w @ w / 2 + cost * (short**2).sum()


def best(x, y, c, cost):
    """Newton's steps on the primal, which is smooth."""
    one, s = np.hstack([x, np.ones((len(x), 1))]), np.where(y == c, 1.0, -1.0)
    w = np.zeros(one.shape[1])
    for _ in range(50):
        held = one[s * (one @ w) < 1]
        signs = s[s * (one @ w) < 1]
        w = np.linalg.solve(np.eye(len(w)) + 2 * cost * held.T @ held, 2 * cost * held.T @ signs)
    return w


@pytest.mark.parametrize("parts", [1, 4])
def test_reaches_the_optimum_and_closes_the_gap(spark, data, parts):
    x, y = data
    model = SquaredHingeSvm(c=0.5, gap=1e-4, rounds=100).fit(table(spark, x, y).repartition(parts))
    assert model.gaps[-1] < 1e-4 and len(model.gaps) < 20
    for c in range(3):
        least = loss(best(x, y, c, 0.5), x, y, c, 0.5)
        assert least <= loss(model.weights[c], x, y, c, 0.5) <= least * 1.0002


def test_predictions_follow_the_margins(spark, data):
    x, y = data
    df = table(spark, x, y)
    model = SquaredHingeSvm(rounds=30).fit(df)
    margins = np.hstack([x, np.ones((len(x), 1))]) @ model.weights.T
    for r in model.transform(df).collect():
        assert np.allclose(list(r.rawPrediction), margins[r.id]) and r.prediction == margins[r.id].argmax()


def test_nulls_and_no_rows(spark, data):
    x, y = data
    df = table(spark, x, y).union(spark.createDataFrame([(900, None, 1), (901, [0.0] * 5, None)], SCHEMA))
    got = {r.id: r for r in SquaredHingeSvm(rounds=5).fit(df).transform(df).where("id >= 900").collect()}
    assert got[900].prediction is None and got[901].prediction is not None
    with pytest.raises(ValueError):
        SquaredHingeSvm().fit(df.where(F.lit(False)))


def test_closes_the_gap_where_planes_part_all_rows(spark):
    rng = np.random.default_rng(8)
    x = np.hstack([np.eye(4)[rng.integers(0, 4, 600)], rng.normal(size=(600, 2))])
    df = table(spark, x, x[:, :4].argmax(axis=1)).repartition(3)
    model = SquaredHingeSvm().fit(df)
    assert model.gaps[-1] < 1e-3 and len(model.gaps) < 40
    assert model.transform(df).where("prediction <> label").isEmpty()


def test_equal_rows_are_held_once_and_count_as_many(spark, data):
    x, y = data[0][:90], data[1][:90]
    df = table(spark, np.tile(x, (6, 1)), np.tile(y, 6)).repartition(4)
    blocks = SquaredHingeSvm._blocks(df.select(F.col("features").alias("x"), "label"), 3, 6).collect()
    assert sum(len(b[0]) for b in blocks) == 90 and sum(b[2].sum() for b in blocks) == 540
    model = SquaredHingeSvm(c=0.5, gap=1e-4).fit(df)
    for c in range(3):
        least = loss(best(x, y, c, 3.0), x, y, c, 3.0)  # six times the cost is six copies
        assert least <= loss(model.weights[c], x, y, c, 3.0) <= least * 1.0002
