"""Boosted trees: the first cuts against a plain search, both flavours on tables with a known answer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyglint.operators import boosting as bo

SCHEMA = "id long, features array<double>, label int"


def table(spark, x, y):
    rows = [(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def rule():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 20, size=(900, 4)).astype(float)
    return x, (x[:, 0] >= 10).astype(int) + (x[:, 2] >= 5)


def plain_first_split(x, y, c, classes):
    p = 1 / classes
    g, h = p - (y == c), np.full(len(y), 2 * p * (1 - p))
    best = (-np.inf,)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
            gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
            if min(hl, hr) >= 1 and gain > best[0] + 1e-9:
                best = (gain, f, cut, -0.1 * gl / (hl + 1), -0.1 * gr / (hr + 1))
    return best


@pytest.mark.parametrize("leaves", [None, 2])
def test_first_cut_equals_a_plain_search(spark, rule, leaves):
    x, y = rule
    fit = bo.HistogramBoosting(rounds=1, depth=1, rows=1.0, cols=1.0, leaves=leaves).fit(table(spark, x, y).repartition(3))
    assert fit.losses == [pytest.approx(np.log(3))]
    for c, tree in enumerate(fit.trees[0]):
        _, f, cut, low, high = plain_first_split(x, y, c, 3)
        assert tree.feature[0] == f and fit.edges[f][tree.bin[0]] == pytest.approx(cut + 0.5)
        assert tree.value[1:] == [pytest.approx(low), pytest.approx(high)]


@pytest.mark.parametrize("leaves", [None, 5])
def test_learns_a_rule_and_the_loss_falls(spark, rule, leaves):
    x, y = rule
    df = table(spark, x, y).repartition(3)
    model = bo.HistogramBoosting(rounds=25, depth=3, rate=0.3, leaves=leaves).fit(df.where("id % 4 > 0"))
    assert all(b < a for a, b in zip(model.losses, model.losses[1:]))
    assert all(t.leaves() <= (leaves or 8) for trees in model.trees for t in trees)
    out = model.transform(df.where("id % 4 = 0")).collect()
    assert all(r.prediction == r.label and abs(sum(r.probability) - 1) < 1e-9 for r in out)


def test_best_first_takes_cuts_in_order_of_gain(spark):
    """Four cuts along one feature, then others: strict best-first, however far it looks ahead."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] > 0).astype(int) * ((x[:, 1] > 0.3).astype(int) + (x[:, 0] > 1))
    df = table(spark, x, y).repartition(2)
    near = bo.HistogramBoosting(rounds=2, leaves=7, rows=1.0, cols=1.0, ahead=1).fit(df)
    far = bo.HistogramBoosting(rounds=2, leaves=7, rows=1.0, cols=1.0, ahead=16).fit(df)
    order = lambda t: sorted(zip(t.feature, t.bin, np.round(t.value, 9)))
    for a, b in zip(near.trees, far.trees):
        for one, two in zip(a, b):
            assert one.leaves() == two.leaves() <= 7 and order(one) == order(two)
    level = bo.HistogramBoosting(rounds=2, depth=3, rows=1.0, cols=1.0).fit(df)
    assert [order(t) for t in level.trees[1]] != [order(t) for t in far.trees[1]]


def test_splitting_the_rows_or_the_jobs_changes_nothing(spark, rule, monkeypatch):
    x, y = rule
    df = table(spark, x, y)
    one = bo.HistogramBoosting(rounds=3, depth=3).fit(df.coalesce(1))
    monkeypatch.setattr(bo, "HISTOGRAM_BYTES", 16 * 64 * 3)
    four = bo.HistogramBoosting(rounds=3, depth=3).fit(df.repartition(4))
    assert np.allclose(one.losses, four.losses)
    for a, b in zip(one.trees, four.trees):
        assert all(t.feature == u.feature and t.bin == u.bin and np.allclose(t.value, u.value) for t, u in zip(a, b))


def test_nulls_vectors_and_no_rows(spark):
    from pyspark.ml.functions import array_to_vector

    rows = [(i, [float(i % 2), 0.0], i % 2) for i in range(40)] + [(40, None, 1), (41, [1.0, 0.0], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = bo.HistogramBoosting(rounds=5, depth=2, rows=1.0, cols=1.0).fit(df)
    got = {r.id: r for r in model.transform(df).collect()}
    assert got[40].prediction is None and got[40].probability is None and got[41].prediction == 1
    assert all(got[i].prediction == i % 2 for i in range(40))
    dense = df.where("features is not null").withColumn("features", array_to_vector("features"))
    assert bo.HistogramBoosting(rounds=5, depth=2, rows=1.0, cols=1.0).fit(dense).losses == pytest.approx(model.losses)
    with pytest.raises(ValueError):
        bo.HistogramBoosting().fit(df.where(F.lit(False)))


@pytest.mark.parametrize("leaves", [None, 4])
def test_equal_rows_are_held_once_and_count_as_many(spark, rule, leaves):
    x, y = rule
    x, y = x[:60], y[:60]
    df = table(spark, np.tile(x, (7, 1)), np.tile(y, 7)).repartition(4)
    build = bo.HistogramBoosting(rounds=3, depth=2, rows=0.7, leaves=leaves)
    rows = build._rows(df)
    blocks = build._blocks(rows, build._edges(rows, 4, 420), 3).collect()
    assert sum(len(b[2]) for b in blocks) == len(np.unique(np.column_stack([x, y]), axis=0))
    assert sum(b[3].sum() for b in blocks) == 420
    model = build.fit(df)
    assert model.losses[0] == pytest.approx(np.log(3)) and model.losses[-1] < model.losses[0]
    _, f, cut, low, _ = plain_first_split(np.tile(x, (7, 1)), np.tile(y, 7), 0, 3)
    whole = bo.HistogramBoosting(rounds=1, depth=1, rows=1.0, cols=1.0, leaves=leaves and 2).fit(df).trees[0][0]
    assert whole.feature[0] == f and whole.value[1] == pytest.approx(low)
