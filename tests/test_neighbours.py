"""Neighbours over whole tables against brute force."""

import tracemalloc

import numpy as np
import pytest

from polyglint.operators import neighbours as nb

SCHEMA = "id long, v array<float>"


def table(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)], SCHEMA).repartition(4)


def brute(matrix, k):
    m = np.float32(matrix).astype(float)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    u = np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
    s = np.round(u @ u.T, 9)
    np.fill_diagonal(s, -np.inf)
    return np.argsort(-s, axis=1, kind="stable")[:, :k], s


def by_place(graph):
    return {(r.id, r.place): r for r in graph.collect()}


@pytest.fixture
def points():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    return np.vstack([c + 0.6 * rng.normal(size=(150, 16)) for c in centres])


def test_small_tables_with_hot_copies_are_exact(spark):
    rng = np.random.default_rng(1)
    m = np.vstack([rng.normal(size=(80, 6)), np.tile(rng.normal(size=6), (60, 1)), np.zeros((3, 6))])
    order, sims = brute(m, 5)
    got = by_place(nb.neighbour_graph(table(spark, m), "id", "v", 5))
    assert len(got) == 5 * len(m)
    for i in range(140):
        assert [got[i, p + 1].neighbour for p in range(5)] == order[i].tolist()
        assert np.allclose([got[i, p + 1].similarity for p in range(5)], sims[i, order[i]])


def test_recall_on_a_table_of_many_cells(spark, points, monkeypatch):
    for name, value in (("CELL_ROWS", 16), ("COARSE", 8), ("SHARD_ROWS", 200), ("QUERY_ROWS", 300), ("LEAST_PROBES", 4)):
        monkeypatch.setattr(nb, name, value)
    df = table(spark, points)
    order, _ = brute(points, 10)
    truth = nb.exact_neighbours(df.where("id % 50 = 0"), df, 10)
    found = by_place(truth)
    assert all([found[i, p + 1].neighbour for p in range(10)] == order[i].tolist() for i in range(0, len(points), 50))
    graph = nb.neighbour_graph(df, "id", "v", 10).cache()
    assert graph.count() == 10 * len(points)
    row = nb.recall_of(graph, truth).first()
    assert (row.queries, row.pairs) == (36, 360) and row.recall >= 0.9


def test_a_cell_larger_than_a_shard_is_dealt_to_several(monkeypatch):
    monkeypatch.setattr(nb, "SHARD_ROWS", 1 << 14)
    rng = np.random.default_rng(5)
    cells = nb._unit(rng.normal(size=(6, 4)))
    shards = nb._shards({0: 40_000, 1: 100, 2: 16_000, 3: 500}, cells)
    assert len(shards[0]) == 3 and all(len(s) == 1 for s in shards[1:])
    assert not set(shards[0]) & {x for s in shards[1:] for x in s}


def test_null_vectors_few_rows_and_empty_tables(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (None, [1.0, 0.0]), (3, [0.0, 1.0])]
    got = nb.neighbour_graph(spark.createDataFrame(rows, SCHEMA), "id", "v", 5).collect()
    assert sorted((r.id, r.neighbour, r.similarity, r.place) for r in got) == [(1, 3, 0.0, 1), (3, 1, 0.0, 1)]
    assert nb.neighbour_graph(spark.createDataFrame([], SCHEMA), "id", "v").count() == 0


def test_recall_counts_missing_pairs(spark):
    truth = spark.createDataFrame([(1, 2), (1, 3), (4, 5)], "id int, neighbour int")
    graph = spark.createDataFrame([(1, 2), (4, 9)], "id int, neighbour int")
    assert nb.recall_of(graph, truth).first().recall == pytest.approx(1 / 3)


def test_many_cells_are_ranked_in_pieces():
    rng = np.random.default_rng(6)
    cells, rows = nb.Cells(nb._unit(rng.normal(size=(30_000, 8)))), rng.normal(size=(1024, 8))
    tracemalloc.start()
    near = cells.ranked(rows, 3)
    home = cells.ranked(rows, 1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 5 * 8 * nb.HELD  # all similarities alone are 246 MB
    few = nb._unit(rows[:50]) @ cells.centroids.T
    assert (near[:50] == np.argsort(-few, axis=1, kind="stable")[:, :3]).all() and (home[:, 0] == near[:, 0]).all()
