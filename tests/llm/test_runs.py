"""Periodic runs against a plain search for every period."""

import hashlib
import random
import zlib

import pytest

from helpers import WORD, documents
from polyglint.llm import periodic_runs
from polyglint.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_texts(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            root = [rng.choice("abc") if rng.random() < 0.5 else rng.choice("abcdefgh") for _ in range(rng.randint(1, 40))]
            part = root * rng.randint(1, 9)
            words += part[: len(part) - rng.randint(0, len(root) - 1)]
        texts.append(rng.choice([" ", "\n", " \t "]).join(words))
    texts += [
        "", None, " \n ", "a", "a " * 5, "a " * 6, "a " * 5000, "a b " * 3, "a b " * 4, "x " + "a b " * 900 + "a",
        ("a a a a a b " * 300) + "c", "é ü " * 40, " ".join(f"w{i % 700}" for i in range(2799)),
        " ".join(f"w{i % 700}" for i in range(2800)), " ".join(f"w{i % 700}" for i in range(3500)) + " end",
        "ab a b " * 12 + "aba b " * 12,
    ]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_and_collapsed_equal_plain(spark, seed):
    texts = list(enumerate(some_texts(seed)))
    got = {r.doc_id: r for r in periodic_runs.find_runs(documents(spark, texts).repartition(3)).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        words = WORD.findall(text or "")
        want = plain_runs(words)
        assert got[i].n_words == len(words)
        assert [tuple(r) for r in got[i].runs] == want, (i, text)
        assert got[i].collapsed == collapsed(words, want)


def test_repeated_ids_nulls_and_extra_columns(spark):
    schema = "doc_id long, text string, row int, runs string, period int, words string"
    data = [(1, "a " * 9, 1, "x", 2, "w"), (1, "a b " * 9, 1, "x", 2, "w"), (None, "c " * 9, 1, "x", 2, "w"), (2, None, None, None, None, None)]
    rows = periodic_runs.find_runs(spark.createDataFrame(data, schema)).collect()
    assert sorted((r.doc_id or 0, r.collapsed, len(r.runs)) for r in rows) == [(0, "c", 1), (1, "a", 1), (1, "a b", 1), (2, "", 0)]
    assert periodic_runs.find_runs(spark.createDataFrame([], schema)).count() == 0


def test_a_very_long_text(spark):
    root = [f"w{i}" for i in range(30_000)]
    words = ["z"] * 100_000 + (root * 5)[:140_000] + ["y"] + ["p", "q"] * 50_000
    got = periodic_runs.find_runs(documents(spark, [(1, " ".join(words))])).first()
    assert [tuple(r) for r in got.runs] == [(0, 100_000, 1), (100_000, 140_000, 30_000), (240_001, 100_000, 2)]


def test_query_equals_plain(spark):
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, FOLDER).collect()}
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(table)
    planted = 0
    for doc_id, text in table:
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = plain_runs(words)
        planted += bool(runs)
        row = got[doc_id]
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        if runs:
            s, length, q = min(runs, key=lambda r: (-(r[1] / r[2]), r[0], r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, length, q, 1000 * length // q)
        else:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
    assert planted > 5
