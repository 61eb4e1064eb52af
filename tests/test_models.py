"""Metrics, vectors, projection and training on small frames."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from polyglint.operators import classify as cl
from polyglint.operators import evaluate as ev
from polyglint.operators import features as ft
from polyglint.operators import projection as pj


def test_auc_edges(spark):
    def auc(rows):
        return ev.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first().auc

    assert auc([(0, 1.0), (1, 1.0), (0, 1.0)]) == 0.5
    assert auc([(0, 0.1), (0, 0.2), (1, 0.3)]) == 1.0
    assert math.isnan(auc([(1, 0.1), (1, 0.2)]))
    rng = random.Random(5)
    rows = [(rng.randrange(2), round(rng.gauss(0, 1), 1)) for _ in range(200)]
    assert auc(rows) == pytest.approx(1 - auc([(y, -s) for y, s in rows]))
    pairs = [(a, b) for y, a in rows if y for z, b in rows if not z]
    brute = sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs)
    assert auc(rows) == pytest.approx(brute)


def test_metrics_match_the_built_in_evaluator(spark):
    rng = random.Random(2)
    rows = [(float(rng.randrange(3)), float(rng.randrange(3))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = ev.weighted_metrics(df, "label", "prediction").first()
    for name, key in [("accuracy", "accuracy"), ("f1", "f1"), ("weightedPrecision", "precision"), ("weightedRecall", "recall")]:
        assert ours[key] == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(df))


def test_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "y string, p string")
    report = {r["class"]: (r.precision, r.recall, r.f1) for r in ev.class_report(df, "y", "p").collect()}
    assert report["b"] == (0.0, 0.0, 0.0) and report["a"] == (0.5, 1.0, pytest.approx(2 / 3))
    matrix = {r.actual: (r.pred_a, r.pred_b) for r in ev.confusion_matrix(df, "y", "p", ["a", "b"]).collect()}
    assert matrix == {"a": (1, 0), "b": (1, 0)}


def test_l2_and_softmax(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(ft.l2_normalise(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]
    [first, second] = [r[0] for r in df.select(ft.softmax(F.col("v"))).collect()]
    assert sum(first) == pytest.approx(1) and first[1] > first[0] and second == [0.5, 0.5]


def test_labels_alphabetical_with_fill(spark):
    df = spark.createDataFrame([("pos",), (None,), ("neg",)], "l string")
    assert {r.l: r.i for r in ft.encode_labels(df, "l", "i").collect()} == {"pos": 2, None: 1, "neg": 0}


def test_labels_of_many_classes(spark):
    df = spark.range(4000).selectExpr("string(id % 2000) l")
    out = ft.encode_labels(df, "l", "i")
    assert out.count() == 4000 and out.select("i").distinct().count() == 2000


def test_tfidf_weights(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "a c"), (3, "b c c")], "id int, t string")
    out = {(r.id, r.term): r.weight for r in ft.tfidf_long(docs, "id", "t", min_df=2, ngrams=False).collect()}
    idf = math.log(4 / 3) + 1
    raw = {"a": (1 + math.log(2)) * idf, "b": idf}
    norm = math.hypot(*raw.values())
    assert out[(1, "a")] == pytest.approx(raw["a"] / norm) and out[(1, "b")] == pytest.approx(raw["b"] / norm)
    for i in (1, 2, 3):
        assert sum(w * w for (d, _), w in out.items() if d == i) == pytest.approx(1)


def test_terms_are_counted_within_their_row(spark):
    rows = [(1, ["b", "a", "b", None, "b"]), (2, []), (3, None), (4, ["z"])]
    docs = spark.createDataFrame(rows, "id int, ts array<string>")
    counts = ft.term_counts(docs, "id", F.col("ts"))
    out = {(r.id, r.term): r.tf for r in counts.collect()}
    assert out == {(1, "a"): 1, (1, "b"): 3, (1, None): 1, (4, "z"): 1}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_tasks_that_count_terms_hold_bounded_text_whatever_the_scan_splits(spark, monkeypatch):
    monkeypatch.setattr(ft, "TASK_CHARS", 500, raising=False)
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(30))) for i in range(400)] + [(400, None)]
    docs = spark.createDataFrame(rows, "id int, t string").coalesce(1)
    want = Counter(word for _, t in rows for word in (t or "").split())
    held = Counter(word for _, t in rows for word in set((t or "").split()))
    vocab = ft.tfidf_vocabulary(docs, "id", "t", max_features=50, max_df=1.0, ngrams=False)
    first = sorted(want, key=lambda w: (-want[w], w))[:50]
    assert [(r.term, r.df, r.total) for r in vocab.collect()] == [(w, held[w], want[w]) for w in first]

    tasks = sum(len(t or "") for _, t in rows) // 500 + 1
    totals = ft.term_totals(docs, "id", "t", F.split("t", " "))
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert f"), {tasks})" in plan and totals.rdd.getNumPartitions() == tasks // 4 > 4
    placed = ft.placed_by(docs, "id", "t").withColumn("p", F.spark_partition_id())
    most = placed.groupBy("p").agg(F.sum(F.length("t")).alias("n")).agg(F.max("n")).first()[0]
    assert most < 10 * 500


def test_vectors_need_no_shuffle_of_their_cells(spark):
    """The cells of a row are put together where its terms were counted, and not stored between."""
    docs = spark.createDataFrame([(1, "a a b"), (2, "a b"), (3, "")], "id int, t string")
    vocab = ft.tfidf_vocabulary(docs, "id", "t", max_df=1.0, ngrams=False)
    long = ft.tfidf_long(docs, "id", "t", vocab=vocab)
    vectors = ft.sparse_vectors(long, docs, "id", ft.term_index(vocab), 2)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id#") == 2  # the texts, and the ids
    own = ft.tfidf_long(docs, "id", "t", max_df=1.0, ngrams=False)
    assert sorted(long.collect()) == sorted(own.collect())
    assert {r.id: r.features.numNonzeros() for r in vectors.collect()} == {1: 2, 2: 2, 3: 0}


def test_term_vectors_are_digested_without_filling_in_zeros(spark):
    rows = entry_point.queries()["e1_tfidf_vectors"](spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "unwrap_udt" in plan and "UDF(features" not in plan


def test_sparse_vectors_cover_empty_documents(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "a b"), (3, "")], "id int, t string")
    long = ft.tfidf_long(docs, "id", "t", max_df=1.0, ngrams=False)
    index = ft.term_index(long.select("term").distinct())
    out = {r.id: r.features for r in ft.sparse_vectors(long, docs, "id", index, 2).collect()}
    assert out[3].numNonzeros() == 0 and out[1].norm(2) == pytest.approx(1)


def test_subwords_give_unseen_words_a_vector(spark):
    docs = spark.createDataFrame([(1, ["running", "runner", "jumps"] * 4), (2, ["jumping", "running"] * 4)], "id int, tokens array<string>")
    model = ft.train_word2vec(docs, "tokens", size=8, min_count=1, epochs=1)
    vectors = ft.subword_vectors(model.getVectors(), buckets=256)
    new = spark.createDataFrame([(9, ["runs"]), (10, [])], "id int, tokens array<string>")
    out = {r.id: r.features for r in ft.subword_pool(new, "id", F.col("tokens"), vectors, 8, buckets=256).collect()}
    assert np.linalg.norm(out[9].toArray()) > 0 and np.linalg.norm(out[10].toArray()) == 0
    pooled = {r.id: r.features.toArray() for r in ft.mean_pool(docs, "id", F.col("tokens"), model.getVectors(), 8, hot=1).collect()}
    for r in model.transform(docs).collect():
        assert pooled[r.id] == pytest.approx(r.features.toArray(), abs=1e-6)
    assert ft.similar_words(model, "nowhere").count() == 0


def test_pca_equals_svd(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(60, 6)) @ rng.normal(size=(6, 6)) + 3
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "id int, v array<double>")
    from pyspark.ml.functions import array_to_vector

    fitted = pj.fit_pca(df.withColumn("f", array_to_vector("v")), "f", 2)
    got = np.array([r.coords for r in fitted.transform(df.withColumn("f", array_to_vector("v"))).orderBy("id").collect()])
    centred = data - data.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    want = centred @ vt[:2].T
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-8
    assert fitted.explained == pytest.approx(list((s**2 / (s**2).sum())[:2]))


def test_knn_equals_brute_force_with_copies(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(90, 5))
    data[30:60] = data[0]  # a third of the rows are copies of one
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "id long, v array<double>")
    out = pj.knn_graph(df, "id", "v", k=4, block_rows=20)
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -np.inf)
    rows = {}
    for r in out.collect():
        rows.setdefault(r.id, []).append((r.place, r.similarity))
    assert len(rows) == 90
    for i, found in rows.items():
        assert [s for _, s in sorted(found)] == pytest.approx(sorted(sims[i])[::-1][:4])


def test_silhouette_brute_force(spark):
    rng = np.random.default_rng(1)
    pts, labels = rng.normal(size=(40, 3)), [i % 3 if i < 39 else 7 for i in range(40)]
    df = spark.createDataFrame([(i, p.tolist(), l) for i, (p, l) in enumerate(zip(pts, labels))], "id int, xy array<double>, l int")
    dist = np.linalg.norm(pts[:, None] - pts[None], axis=2)
    total = []
    for i in range(40):
        mean = {c: dist[i, [j for j in range(40) if labels[j] == c and j != i]].mean() for c in set(labels) if c != labels[i] or labels.count(c) > 1}
        b = min(v for c, v in mean.items() if c != labels[i])
        a = mean.get(labels[i])
        total.append(0.0 if a is None else (b - a) / max(a, b))
    assert pj.silhouette(df, "id", "xy", "l").first().silhouette == pytest.approx(np.mean(total))


def test_classifiers_beat_the_majority(spark):
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(8)
    rows = [(i, float(i % 3), (rng.normal(size=3) * 0.3 + np.eye(3)[i % 3]).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, label double, v array<double>").withColumn("features", array_to_vector("v")).drop("v")
    data = cl.with_split(df, "id")
    models = {"Logistic Regression": lambda: cl.logistic(120, max_iter=50), "Boosted Trees": lambda: cl.boosted_trees(2, 3)}
    out = cl.run_block("dense", data, "id", models, 3).collect()
    assert {r.model for r in out} == set(models)
    for r in out:
        assert r.accuracy > 0.6 and 0.5 < r.auc <= 1
    assert cl.run_block("none", None, "id", models, 3) is None


def _two_topics(spark, n=300):
    rng = random.Random(7)
    groups = [["planting", "planter", "gardens", "seeding"], ["sailing", "sailor", "harbour", "anchors"]]
    rows = [(i, [rng.choice(groups[i % 2]) for _ in range(12)]) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, ["gardens"])]
    return spark.createDataFrame(rows, "id long, tokens array<string>")


def test_every_ngram_is_trained_on_once_and_meets_other_words(spark):
    df = spark.createDataFrame([(1, ["abcd", "xy", "abcd"]), (2, None), (3, [])], "id long, tokens array<string>")
    lines = ft.subword_sequences(df, "id", F.col("tokens"), 3, 4).collect()
    once = df.where("id = 1").select(F.explode("tokens").alias("w")).select(ft.subword_buckets(F.col("w"), 3, 4, 1 << 16).alias("b"))
    want = sorted(str(b) for r in once.collect() for b in r.b)
    assert sorted(g for r in lines for g in r.grams) == want
    assert {r.id for r in lines} == {1} and max(len(r.grams) for r in lines) <= 3


def test_subword_vectors_know_topics_and_unseen_words(spark):
    df = _two_topics(spark)
    grams = ft.train_subword_vectors(df, "id", F.col("tokens"), size=16, epochs=10, buckets=4096)
    assert grams.groupBy("bucket").count().where("count > 1").isEmpty()
    words = df.select(F.explode("tokens").alias("w")).distinct().unionByName(spark.createDataFrame([("gardened",)], "w string"))
    vectors = ft.subword_word_vectors(words, "w", grams, buckets=4096).cache()
    near = [r.word for r in ft.nearest_words(vectors, "gardened", 4).collect()]  # seen in no document
    assert set(near) == {"planting", "planter", "gardens", "seeding"} and near[0] == "gardens"
    similar = ft.nearest_words(vectors, "harbour", 8).collect()
    assert {r.word for r in similar[:3]} == {"sailing", "sailor", "anchors"}
    assert [r.similarity for r in similar] == sorted((r.similarity for r in similar), reverse=True)
    assert ft.nearest_words(vectors, "nowhere").count() == 0


def test_subword_training_without_words(spark):
    df = spark.createDataFrame([(1, []), (2, None)], "id long, tokens array<string>")
    grams = ft.train_subword_vectors(df, "id", F.col("tokens"), size=8)
    pooled = ft.subword_pool(df, "id", F.col("tokens"), grams, 8).collect()
    assert grams.count() == 0 and all(r.features.toArray().tolist() == [0.0] * 8 for r in pooled)


def test_mean_pool_adds_up_a_task_s_words_before_they_move(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "c", "c"]), (2, ["b", "d", "zz"]), (3, []), (4, None), (5, ["a"])], "id long, tokens array<string>")
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("c", [4.0, 4.0]), ("d", [6.0, 0.0])]
    vectors = spark.createDataFrame(rows, "word string, v array<double>").select("word", array_to_vector("v").alias("vector"))
    pooled = ft.mean_pool(docs, "id", F.col("tokens"), vectors, 2, hot=1)
    got = {r.id: list(r.features) for r in pooled.collect()}
    assert got == {1: [2.25, 2.5], 2: [3.0, 1.0], 3: [0.0, 0.0], 4: [0.0, 0.0], 5: [1.0, 0.0]}
    assert pooled._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 3


def test_the_experiment_grid_trains_every_model_at_its_full_size(spark, monkeypatch):
    from polyglint.bindings import models as bound

    docs = spark.createDataFrame([(i, f"w{i % 3}", "en") for i in range(10)], "doc_id long, text string, lang string")
    monkeypatch.setattr(bound, "_word2vec", lambda t: (docs, None))
    monkeypatch.setattr(bound, "_subwords", lambda t: (docs, None))
    monkeypatch.setattr(bound, "_pooled", lambda docs, words: "words")
    monkeypatch.setattr(bound.ft, "subword_pool", lambda *a: "grams")
    monkeypatch.setattr(bound, "_tfidf", lambda t, size=8000: ("terms", size))
    monkeypatch.setattr(bound, "_dataset", lambda t, vectors: vectors)
    grid = {}

    def run_block(name, df, id_col, models, classes):
        grid[name] = df, {model: build() for model, build in models.items()}
        return docs.select("doc_id").limit(0)

    monkeypatch.setattr(bound.cl, "run_block", run_block)
    monkeypatch.setattr(bound.Tables, "documents", docs, raising=False)
    entry_point.queries()["m13_experiment_grid"](spark, "/none")
    assert {name: df for name, (df, _) in grid.items()} == {"TF-IDF": ("terms", 8000), "Word2Vec": "words", "Subword": "grams"}
    for name, (_, models) in grid.items():
        assert models["Logistic Regression"].getMaxIter() == 1000 and models["Linear SVM"].rounds == cl.linear_svm(8).rounds
        assert (models["Boosted Trees"].rounds, models["Boosted Trees"].depth) == (300, 6)
        assert (models["Boosted Trees (best first)"].rounds, models["Boosted Trees (best first)"].leaves) == (300, 63)
        assert models["Perceptron"].getLayers() == [8000 if name == "TF-IDF" else 128, 512, 256, 128, 4]
        assert models["Perceptron"].getMaxIter() == 20
