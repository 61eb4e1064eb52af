"""Collocations against a plain count of everything."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from polyglint.llm import collocations

SCHEMA = "lang string, text string"


def plain(rows, min_count, top, percent=100):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = []
    often = {p: c for p, c in f.items() if c >= min_count and len(p[1]) > 1}
    around = Counter()
    for (lang, p), c in often.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                around[lang, p[i : i + m]] = max(around[lang, p[i : i + m]], c)
    for (lang, p), a in often.items():
        if 100 * around[lang, p] >= percent * a:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(ranked)


def some_rows(seed, rows=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Émile", "ÉMILE", "Aé", " x", "don't"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    out = []
    for _ in range(rows):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(["the New York times", "in as much as", "x y x y x", "ha ha ha ha ha ha"]).split()
        out.append((rng.choice(["en", "en", "de", None]), "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "\x0b"]) for w in words)))
    return out + [("en", None), (None, ""), ("xx", "once only"), ("en", " .,;\n")]


def mined(df, **options):
    return sorted(tuple(r) for r in collocations.collocations(df, **options).collect())


@pytest.mark.parametrize("seed, min_count, top, percent", [(1, 8, 2000, 100), (2, 20, 15, 60)])
def test_equals_plain(spark, seed, min_count, top, percent):
    rows = some_rows(seed)
    want = plain(rows, min_count, top, percent)
    assert len(want) > 20
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(3), min_count=min_count, top=top, percent=percent) == want


@pytest.mark.parametrize("share, slack", [(0.01, 0.5), (0.3, 3.0)])
def test_a_poor_sample_only_costs_passes(spark, monkeypatch, share, slack):
    monkeypatch.setattr(collocations, "SAMPLE", share)
    monkeypatch.setattr(collocations, "SLACK", slack)
    rows = some_rows(3)
    assert mined(spark.createDataFrame(rows, SCHEMA), min_count=8) == plain(rows, 8, 2000)


def test_a_tiny_filter_only_costs_counts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_BITS", 128)
    rows = some_rows(4)
    assert mined(spark.createDataFrame(rows, SCHEMA), min_count=8) == plain(rows, 8, 2000)


def test_phrases_outside_the_hot_ones(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HOT_SHARE", 0.05)
    rows = some_rows(5)
    assert mined(spark.createDataFrame(rows, SCHEMA), min_count=8) == plain(rows, 8, 2000)


def test_long_texts_are_cut_where_no_phrase_passes(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 500)
    rows = [("en", " ".join(t or "" for _, t in some_rows(6))), ("en", "a b " * 400)]
    assert mined(spark.createDataFrame(rows, SCHEMA), min_count=10) == plain(rows, 10, 2000)


def test_equal_codes_are_told_apart():
    import numpy as np

    codes = np.array([7, 7, 7, 9], np.uint64)
    first, sizes = collocations._grouped(codes, [np.array([1, 2, 1, 1]), np.array([5, 5, 5, 5])])
    assert sorted(sizes.tolist()) == [1, 1, 2] or sorted(sizes.tolist()) == [1, 3]


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(7)
    rows = [(a, a * rng.randint(1, 10**6), a + rng.randint(0, 10**9), a + rng.randint(0, 10**9)) for a in (rng.randint(100, 10**11) for _ in range(300))]
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    got = df.select("*", collocations.cut_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r.s == 1000 * r.a * r.n // (r.l * r.r) for r in got)


def test_empty_table_and_clashing_columns(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    rows = [(i, "en", "big deal here", "x", 1, 2) for i in range(120)]
    df = spark.createDataFrame(rows, "n int, lang string, text string, phrase string, k int, code int")
    assert mined(df) == [("en", 1, "big deal here", 120, 120, 120, 360, 3000)]
