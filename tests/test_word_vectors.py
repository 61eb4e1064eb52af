import numpy as np
import pytest
from pyspark.sql import functions as F

from polyglint.operators import features as ft
from polyglint.operators import word_vectors as wv


def test_every_word_has_its_own_vector_in_a_model_of_few_buckets(spark):
    groups = [[f"{g}{i}" for i in range(40)] for g in ("sea", "land")]
    rng = np.random.default_rng(3)
    rows = [(i, [str(w) for w in rng.choice(groups[i % 2], 30)]) for i in range(200)]
    rows += [(900, ["alone"]), (901, None), (902, []), (903, [None])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    vectors = wv.train_word_vectors(df, "id", "tokens", size=16, buckets=64)  # 81 words share them
    held = {r.word: r.vector.toArray() for r in vectors.collect()}
    assert set(held) == {*groups[0], *groups[1], "alone"} and all(np.linalg.norm(v) > 0 for v in held.values())
    assert len({v.tobytes() for v in held.values()}) == len(held)
    near = [r.word for r in ft.nearest_words(vectors, "sea1", 10).collect()]
    assert sum(w.startswith("sea") for w in near) >= 8


def test_hot_and_rare_words_are_pooled_alike(spark):
    rows = [(1, ["a", "a", "b", "zz"]), (2, ["c"]), (3, ["zz"]), (4, None), (5, []), (6, [None, "b"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, -1.0]), ("c", [0.5, 0.0])], "word string, v array<double>")
    vectors = vectors.select("word", ft.array_to_vector("v").alias("vector"))
    want = {1: [2.0, 1.0], 2: [0.5, 0.0], 3: [0.0, 0.0], 4: [0.0, 0.0], 5: [0.0, 0.0], 6: [4.0, -1.0]}
    for hot in (1, 2, 100):
        pooled = ft.mean_pool(df, "id", F.col("tokens"), vectors, 2, hot=hot).collect()
        assert {r.id: r.features.toArray().tolist() for r in pooled} == {k: pytest.approx(v) for k, v in want.items()}


def test_runs_are_summed_at_any_length():
    rng = np.random.default_rng(1)
    values = rng.random((200, 3))
    starts, at, weights = np.array([0, 1, 33, 140]), rng.integers(0, 200, 150), rng.random(150)
    ends = [*starts[1:], 150]
    for w in (None, weights):
        want = [((1 if w is None else w[a:b, None]) * values[at[a:b]]).sum(axis=0) for a, b in zip(starts, ends)]
        assert wv.run_sums(values, starts, 150, at, w) == pytest.approx(np.array(want))


def test_pairs_of_a_word_are_counted_in_its_task(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [f"w{j}" for j in rng.integers(0, 30, rng.integers(0, 40))]) for i in range(50)] + [(99, ["alone"]), (98, [])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>").coalesce(1)
    drawn = df.select("id", F.posexplode("tokens").alias("at", "w")).select(
        "id", "at", wv.hash_bucket(F.col("w"), 16).alias("bucket"), (F.pmod(F.xxhash64("id", "at", F.lit(42)), F.lit(5)) + 1).alias("reach"))
    places = {(r.id, r.at): (r.bucket, r.reach) for r in drawn.collect()}
    want = {}
    for i, words in rows:
        for at, w in enumerate(words):
            held = want.setdefault(w, {})
            for near in range(max(0, at - places[i, at][1]), min(len(words), at + places[i, at][1] + 1)):
                if near != at:
                    held[places[i, near][0]] = held.get(places[i, near][0], 0) + 1
    for most in (1 << 20, 100):  # in one go, and some documents at a time
        monkeypatch.setattr(wv, "COUNT_TOKENS", most)
        found, lines = {}, wv.word_pairs(df, "id", "tokens", 5, 16).collect()
        for r in lines:
            held = found.setdefault(r.word, {})
            for c, n in zip(np.frombuffer(r.contexts, np.int32).tolist(), np.frombuffer(r.n, np.float32)):
                held[c] = held.get(c, 0) + n
        assert found == want and found["alone"] == {}
        assert most == 100 or len(lines) == len(want)  # a row for each word, not for each pair


def test_words_are_fitted_alike_however_their_pairs_come(spark, monkeypatch):
    tables = wv.Tables(8, 4, 1)
    tables.contexts[:], tables.met[:] = tables.parts[::-1], 1
    rows = [("a", 1, [0, 3], [2, 1]), ("a", 1, [3, 5], [1, 4]), ("b", 2, [], []), ("c", 1, [7], [3]), ("c", 1, [7, 2], [1, 1])]
    whole = [("a", 1, [0, 3, 5], [2, 2, 4]), ("b", 2, [], []), ("c", 1, [2, 7], [1, 4])]
    got = []
    monkeypatch.setattr(wv, "SHARED", 64)
    for most, some in ((1 << 20, rows), (1, rows), (1 << 20, whole)):
        monkeypatch.setattr(wv, "FIT_PAIRS", most)
        cells = [(w, b, np.array(c, np.int32).tobytes(), np.array(n, np.float32).tobytes()) for w, b, c, n in some]
        pairs = spark.createDataFrame(cells, "word string, bucket int, contexts binary, n binary").coalesce(1)
        got.append({r.word: r.vector.toArray() for r in wv.fit_words(pairs, tables, 5).collect()})
    assert got[0]["b"] == pytest.approx(tables.parts[2]) and set(got[0]) == {"a", "b", "c"}
    for other in got[1:]:
        assert {w: pytest.approx(v, abs=0.02) for w, v in got[0].items()} == other
    assert {w: pytest.approx(v, abs=1e-6) for w, v in got[0].items()} == got[2]


def test_a_step_equals_its_pairs_one_by_one():
    rng, window, size, buckets = np.random.default_rng(2), 3, 8, 12
    words, line = rng.integers(0, buckets, 50), np.repeat([0, 1, 2], [20, 1, 29])
    ends = np.concatenate([[0], np.cumsum(rng.integers(0, 4, 50))])
    parts, noise = rng.integers(0, buckets, ends[-1]), np.cumsum(np.ones(buckets))
    tables = wv.Tables(buckets, size, 1)
    tables.contexts[:] = rng.random((buckets, size))
    want, first, last = wv.Tables(buckets, size, 1), 5, 45
    want.contexts[:] = tables.contexts
    wv._step(tables, words, line, parts, ends, first, last, window, noise, np.random.default_rng(9))
    draw = np.random.default_rng(9)
    reach = draw.integers(1, window + 1, last - first)
    drawn = np.searchsorted(noise, draw.random(wv.SHARED) * noise[-1], "right")
    sides, met = np.zeros((2, buckets, size)), np.zeros((2, buckets))
    np.add.at(met[1], drawn, 1)
    pull = lambda a, b: 1 / (1 + np.exp(-a @ b))
    for i in range(first, last):
        own = parts[ends[i] : ends[i + 1]]
        if not len(own):
            continue
        h, g, pairs = want.parts[own].mean(axis=0), np.zeros(size), 0
        for j in range(max(0, i - reach[i - first]), min(50, i + reach[i - first] + 1)):
            if j != i and line[i] == line[j]:
                p = pull(h, want.contexts[words[j]]) - 1
                g, pairs = g + p * want.contexts[words[j]], pairs + 1
                sides[1, words[j]] += p * h
                met[1, words[j]] += 1
        for c in drawn:
            p = pull(h, want.contexts[c]) * pairs * wv.NEGATIVES / wv.SHARED
            g = g + p * want.contexts[c]
            sides[1, c] += p * h
        np.add.at(sides[0], own, g / len(own))
        np.add.at(met[0], own, pairs + 1e-6)
    for side, (table, moved) in enumerate(((want.parts, tables.parts), (want.contexts, tables.contexts))):
        sums = 1e-8 + (sides[side] ** 2).mean(axis=1, keepdims=True)
        assert moved == pytest.approx(table - sides[side] * wv.RATE / np.sqrt(sums), abs=1e-5)
        assert tables.met[side] == pytest.approx(met[side], abs=1e-3)


def test_a_table_in_few_splits_is_dealt_over_all_cores(spark):
    from polyglint.session import dealt

    cores = spark.sparkContext.defaultParallelism
    lone, wide = spark.range(1000).coalesce(1), spark.range(1000).repartition(3 * cores)
    rows = dealt(lone)
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert rows.rdd.getNumPartitions() == cores == len(sizes) and max(r["count"] for r in sizes) < 2000 / cores
    assert {r.id for r in rows.collect()} == set(range(1000)) and dealt(wide) is wide
