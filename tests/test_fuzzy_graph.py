"""Membership weights of neighbour lists against a plain NumPy reckoning."""

import math

import numpy as np
import pytest

from polyglint.operators import fuzzy_graph as fz
from polyglint.operators import neighbours as nb
from polyglint.operators import projection as pj

EDGES = "id long, neighbour long, similarity double"


def _plain(rows):
    """Memberships by search over widths, then the union, pair by pair."""
    directed = {}
    for me in {r[0] for r in rows}:
        links = sorted((max(1 - s, 0.0), b) for a, b, s in rows if a == me)
        d = np.array([x for x, _ in links])
        apart = d[d > 0]
        rho = apart.min() if len(apart) else 0.0
        excess, wanted = np.maximum(d - rho, 0), math.log2(len(d))
        low, high = 0.0, 1e6
        for _ in range(200):
            middle = (low + high) / 2
            if np.where(excess > 0, np.exp(-excess / middle), 1.0).sum() > wanted:
                high = middle
            else:
                low = middle
        width = max(low, fz.LEAST_SHARE * d.mean())
        for (x, b), e in zip(links, excess):
            directed[me, b] = 1.0 if e <= 0 else math.exp(-e / width)
    out = {}
    for a, b in directed:
        one, two = directed.get((a, b), 0.0), directed.get((b, a), 0.0)
        out[min(a, b), max(a, b)] = one + two - one * two
    return out


def _weights(edges):
    return {(r.source, r.target): r.weight for r in fz.fuzzy_graph(edges).collect()}


def _same(got, want):
    assert got.keys() == want.keys()
    assert all(got[pair] == pytest.approx(want[pair], abs=1e-7) for pair in want)


def test_weights_of_a_table_equal_numpy(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    edges = nb.neighbour_graph(table, "vec_id", "embedding", 15).select("id", "neighbour", "similarity").cache()
    got = _weights(edges)
    _same(got, _plain([tuple(r) for r in edges.collect()]))
    assert max(got.values()) <= 1 + 1e-12 and min(got.values()) > 0


@pytest.mark.parametrize("rows", [
    [(1, 2, 0.5)],  # one link: no bandwidth to look for
    [(1, 2, 0.5), (2, 1, 0.5)],
    [(1, 2, 1.0), (1, 3, 1.0), (1, 4, 1.0)],  # copies: all at distance 0
    [(1, 2, 1.0), (1, 3, 0.9), (1, 4, 0.9), (1, 5, 0.9), (1, 6, 0.2)],  # too many at the nearest
    [(1, 2, 1.0 + 1e-12), (1, 3, -0.5), (1, 4, 0.3), (2, 4, 0.1), (2, 1, 0.2), (2, 3, 0.15)],
])
def test_ties_copies_and_short_lists(spark, rows):
    _same(_weights(spark.createDataFrame(rows, EDGES)), _plain(rows))


def test_nulls_loops_repeats_and_nothing(spark):
    rows = [(1, 2, 0.5), (1, 3, 0.4), (1, 4, 0.1)]
    odd = [(1, 1, 1.0), (None, 2, 0.5), (2, None, 0.5), (1, 5, None), (1, 3, 0.2)]
    frame = spark.createDataFrame([(*r, "x", 1.0) for r in rows + odd], f"{EDGES}, links string, weight double")
    _same(_weights(frame), _plain(rows))
    assert _weights(spark.createDataFrame([], EDGES)) == {}


def test_layout_parts_two_groups(spark):
    rng = np.random.default_rng(0)
    centres = np.array([[1.0, 0, 0, 0], [0, 1.0, 0, 0]])
    points = [(i, (centres[i % 2] + 0.2 * rng.standard_normal(4)).tolist()) for i in range(60)]
    points.append((60, [0.7, 0.7, 0.0, 0.0]))
    frame = spark.createDataFrame(points, "i long, v array<double>")
    weights = fz.fuzzy_graph(nb.neighbour_graph(frame, "i", "v", 8)).toDF("id", "neighbour", "similarity")
    x = {r.id: r.x for r in pj.spectral_layout(weights, rounds=12).collect()}
    left, right = [x[i] for i in range(0, 60, 2)], [x[i] for i in range(1, 60, 2)]
    assert max(left) < min(right) or max(right) < min(left)
