"""Deduplication, decontamination, packing and the pipeline against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from helpers import DOCS, documents, kept_bytes, near_components, rows

from polyglint.llm import decontaminate, line_dedup, near_dedup, packing, substring_dedup
from polyglint.llm.components import components
from polyglint.llm.tokens import Encoder, default_vocabulary

VOCABULARY = [a + b + c for a in "bcdfgmnprst" for b in "aeiou" for c in ("l", "n", "rt", "sk")]


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(VOCABULARY) for _ in range(n))


def edited(text, share, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(VOCABULARY) if pick.random() < share else w for w in text.split(" "))


def test_components(spark):
    pick = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100 + pick.randrange(60), 100 + pick.randrange(60)) for _ in range(45)] + [(7, 7), (300, 299)]
    from helpers import components as plain

    want = plain(edges, {x for e in edges for x in e})
    assert dict(components(spark.createDataFrame(edges, "a long, b long")).collect()) == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    base = [(i, prose(i, 30 + 9 * i)) for i in range(8)]
    texts = base + [(100 + 10 * i + k, edited(t, 0.02 * k, 10 * i + k)) for i, t in base for k in range(6)]
    # more copies than a region compares at once
    texts += [(300 + k, edited(base[5][1], 0.02 + 0.001 * k, 77 + k)) for k in range(40)]
    texts += [(500, ""), (501, None), (502, "Word"), (503, "word"), (504, "\t "), (505, base[1][1].upper()), (506, base[2][1])]
    found = near_dedup.near_duplicates(documents(spark, texts, "doc_id long, text string, kept int", (1,)), width=width)
    want, sets = near_components(texts, width)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()}
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i, _ in texts}


def test_near_duplicates_odd_rows(spark):
    text = prose(1, 50)
    found = near_dedup.near_duplicates(documents(spark, [(None, text), (4, text), (4, text), (9, text)]))
    assert rows(found, "doc_id", "component_id", "kept") == sorted([(None, None, True), (4, 4, True), (4, 4, True), (9, 4, False)], key=repr)
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0


def test_repeated_substrings(spark):
    shared, long = prose(1, 60), prose(2, 40000)
    texts = [(i, prose(10 + i, 20 * i)) for i in range(6)]
    texts += [(20, shared), (21, "intro " + shared + " end"), (22, shared[5:150] + prose(30, 9) + shared[90:]), (23, shared)]
    texts += [(30, "ab" * 300), (31, "x" * 99), (32, "x" * 99), (33, "x" * 100), (34, "x" * 260), (35, None), (36, ""), (37, "é" * 120)]
    texts += [(40, long), (41, long[:100000] + "!" + long[100000:]), (50 , shared[:100]), (51, shared[1:100])]
    texts += [(60 + k, edited(shared, 0.05, k)) for k in range(30)]
    docs = documents(spark, texts, "doc_id long, text string, spans int", (1,)).repartition(5)
    want = kept_bytes(texts, 100)
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == want


def test_repeated_substrings_odd_rows(spark):
    text = prose(5, 50)
    found = substring_dedup.remove_repeats(documents(spark, [(None, text), (3, text), (3, text), (5, text)]))
    assert sorted((r.doc_id or 0, len(r.kept)) for r in found.collect()) == [(0, len(text)), (3, len(text)), (3, len(text)), (5, 0)]
    assert substring_dedup.remove_repeats(documents(spark, [])).count() == 0


def plain_lines(texts):
    from collections import defaultdict

    places = defaultdict(list)
    for i, t in texts:
        for n, line in enumerate((t or "").split("\n")):
            if len(line.strip(" \t\r\x0b\x0c")) >= 20:
                places[line.strip(" \t\r\x0b\x0c")].append((i, n))

    def near(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    first = {line: min(p) for line, p in places.items()}
    earliest = {x: min([first[y] for y in first if y != x and near(x, y)], default=None) for x in first}
    out = {}
    for i, t in texts:
        kept = []
        for n, line in enumerate((t or "").split("\n")):
            bare = line.strip(" \t\r\x0b\x0c")
            gone = bare in first and (first[bare] < (i, n) or earliest[bare] is not None and earliest[bare] < (i, n))
            if not gone:
                kept.append(line)
        out[i] = None if t is None else "\n".join(kept)
    return out


def test_line_dedup(spark):
    line = "a line of text that is long enough to be compared"
    variants = [line[:k] + c + line[k:] for k in (0, 9, 25, len(line)) for c in "xyz"]
    swaps = [line[:k] + c + line[k + 1 :] for k in range(0, len(line), 3) for c in "qz"]
    texts = [(1, line + "\nshort\nshort"), (2, "  " + line + " \nanother line that nobody else has"), (3, "\n".join(variants)), (4, "\n".join(swaps))]
    texts += [(5, None), (6, ""), (7, "é" * 30 + "\n" + "é" * 31 + "\n" + "é" * 33), (8, "\n\n"), (9, line[:-2])]
    texts += [(20 + k, f"number {k:05d} of a numbered list of lines") for k in range(60)]
    docs = documents(spark, texts, "doc_id long, text string, n_near string, _drop int", ("x", 1))
    found = line_dedup.dedup_lines(docs.drop("_drop"))
    assert {r.doc_id: r.text for r in found.collect()} == plain_lines(texts)
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("threshold,few", [(3, 32), (2, 1)])
def test_near_lines_of_several_edits(spark, monkeypatch, threshold, few):
    monkeypatch.setattr(line_dedup, "FEW", few)
    pick = random.Random(threshold)
    base = ["".join(pick.choice("abcd efgh") for _ in range(n)).strip() + "." for n in (24, 39, 41, 58, 60, 62, 80)]
    texts = set(base)
    for line in base:
        for edits in (1, 2, 3, 4) * 3:
            out = list(line)
            for _ in range(edits):
                at = pick.randrange(len(out))
                out[at : at + pick.randint(0, 1)] = pick.choice(["", "x", "y"])
            texts.add("".join(out).strip())
    texts = sorted(x for x in texts if len(x) >= 20)
    allowed = lambda a, b: max(1, min(threshold, min(len(a), len(b)) // 20))
    want = {(a, b) for a in texts for b in texts if a != b and plain_edits(a, b) <= allowed(a, b)}
    assert any(plain_edits(a, b) == threshold for a, b in want)
    lines = line_dedup.lines_of(documents(spark, list(enumerate(texts))))
    text = {r.id: r.line for r in lines.collect()}
    got = [(text[r.id], text[r.other]) for r in line_dedup.near_lines(lines, threshold).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_line_dedup_by_parameters(spark):
    line = "a line of text that is long enough to be compared, and compared again"
    docs = documents(spark, [(1, line + "\nshort"), (2, line.replace("long", "lang").replace("again", "agaim")), (3, "short\n\n\nnew")])
    text = lambda **p: {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, **p).collect()}
    assert text()[2] and text(threshold=2)[2] == ""
    assert text()[3] == "short\n\n\nnew" and text(min_exact_chars=1)[3] == "\n\nnew"


def test_line_dedup_odd_rows(spark):
    line = "a line of text that is long enough to be compared"
    found = line_dedup.dedup_lines(documents(spark, [(None, line), (2, line), (2, line), (3, line)]))
    assert sorted((r.doc_id or 0, r.text) for r in found.collect()) == [(0, line), (2, line), (2, line), (3, "")]


def test_decontamination(spark):
    items = [(i, prose(1000 + i, 12 + 8 * i)) for i in range(12)] + [(50, None), (51, "four words are few"), (52, ""), (None, prose(1, 20)), (3, prose(1003, 36))]
    texts = [(i, prose(i, 300)) for i in range(6)]
    texts += [(10 + i, prose(50 + i, 200) + "\n" + t.upper() + ", " + prose(60 + i, 50)) for i, t in items[:12]]
    texts += [(30 + i, prose(70 + i, 100) + " " + edited(t, 0.03, i) + " " + prose(80 + i, 4000)) for i, t in items[:12]]
    texts += [(60, None), (61, ""), (62, items[4][1][: len(items[4][1]) // 2]), (None, items[5][1])]

    def sets(t):
        w = decontaminate.words_of(t)
        return set(zip(*[w[k:] for k in range(5)]))

    named = {(i, t) for i, t in items if i is not None}
    want = sorted(
        [(d, i, len(sets(t) & sets(x)), len(sets(t))) for d, x in texts for i, t in named if sets(t) and len(sets(t) & sets(x)) >= 0.8 * len(sets(t))],
        key=repr,
    )
    docs = documents(spark, texts, "doc_id long, text string, item_id long", (5,))
    table = spark.createDataFrame(items, "item_id long, text string")
    assert len(want) > 15
    assert rows(decontaminate.find_items(docs, table)) == want
    assert rows(decontaminate.find_items(docs, table, block_words=40)) == want
    clean = decontaminate.remove_contaminated(docs, table, block_words=100)
    hit = {w[0] for w in want}
    assert rows(clean, "doc_id", "item_id") == sorted([(d, 5) for d, _ in texts if d not in hit], key=repr)
    assert decontaminate.find_items(docs, table.limit(0)).count() == 0
    assert decontaminate.find_items(docs.limit(0), table).count() == 0


def test_fill_windows_uses_each_length_once():
    pick = random.Random(1)
    counts = {}
    for _ in range(2000):
        n = pick.randint(1, 100)
        counts[n] = counts.get(n, 0) + 1
    used, windows = {}, 0
    for window, times in packing.fill_windows(counts, 100):
        assert sum(n * c for n, c in window) <= 100
        windows += times
        for n, c in window:
            used[n] = used.get(n, 0) + c * times
    assert used == counts
    least = max(sum(n * c for n, c in counts.items()) / 100, sum(c for n, c in counts.items() if n > 50))
    assert windows <= 1.03 * least + 2


def test_packing(spark):
    texts = [(i, prose(i, 3 * i * i)) for i in range(40)] + [(100, None), (101, ""), (None, "no id"), (5, prose(5, 75)), (102, "½ ² word x 'll  two\x1c"), (103, "<|endoftext|>")]
    found = packing.pack(documents(spark, texts, "doc_id long, text string, start string", ("x",)).repartition(3)).collect()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_vocabulary())
    plain.encode_special_tokens = True
    want = sorted(([repr(i), *plain.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts), key=repr)
    docs, places = {}, {}
    for r in found:
        assert len(r.ids) == 4 * r.length
        docs.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    got = []
    for (i, total), pieces in docs.items():
        ids = np.frombuffer(b"".join(p for _, p in sorted(pieces)), "<u4").tolist()
        for k in range(0, len(ids), total):  # equal rows
            got.append([repr(i), *ids[k : k + total]] if i != 5 else None)
    assert sorted((g for g in got if g), key=repr) == [w for w in want if w[0] != "5"]
    for spots in places.values():
        ends = 0
        for offset, length in sorted(spots):
            assert offset == ends
            ends += length
        assert ends <= 1024
    assert packing.pack(documents(spark, [])).count() == 0


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_vocabulary())
    plain.encode_special_tokens = True
    texts = ["it's we'll 'x  a1b2 _x_y  \n\n z \t", "éÀß×÷ «q» … — ‘’", "日本語 ½", " lead", "trail  ", "", "a\r\nb\x0bc", "1 22 333-4.5e6"]
    assert [x.tolist() for x in Encoder.of(default_vocabulary()).encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    base = [(i, prose(i, 60) + ".\n" + prose(500 + i, 60) + ".") for i in range(60)]
    junk = [(100 + i, " ".join("%$#@"[(i + k) % 4] * 5 for k in range(80))) for i in range(30)]
    leak = prose(9000, 30)
    texts = base + junk + [(200, base[3][1]), (201, base[7][1].replace(".\n", ". ")), (202, prose(44, 90) + " " + leak), (203, base[4][1].split("\n")[0] + "\n" + prose(77, 70))]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100)) for i, _ in base + junk], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    from polyglint.llm.common import settle

    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, str(tmp_path)), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append({r.doc_id: r.text for r in docs.collect()})
    assert set(seen[0]) == {i for i, _ in texts if not 100 <= i < 200}
    assert 200 not in seen[1] and seen[1][203] == prose(77, 70) and set(seen[1]) == set(seen[0]) - {200}
    assert set(seen[2]) == set(seen[1]) - {201}
    assert set(seen[3]) == set(seen[2]) - {202}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(seen[3])
    encoder = Encoder.of(default_vocabulary())
    assert sum(r.length for r in pieces) == sum(len(x) for x in encoder.encode(list(seen[3].values()), 0))


def test_line_dedup_keeps_columns_named_like_its_own(spark):
    line = "one line that is long enough to be compared"
    rows = [(1, line, 5, "x", True), (2, f"{line}\nanother", 6, None, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _drop int, _Doc_Id string, _drop1 boolean")
    found = line_dedup.dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_exact", "n_near", "n_links"]
    assert sorted(tuple(r)[:5] for r in found.collect()) == [(1, line, 5, "x", True), (2, "another", 6, None, False)]


def test_texts_of_lines_without_a_candidate_stay_where_they_are(spark):
    text = F.concat(F.lit("a line that is long enough "), F.col("id"))
    lines = line_dedup.lines_of(spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text")))
    ids = lines.where("doc_id % 100 = 0").select("id")
    likely = line_dedup._likely(lines, ids)
    assert likely.join(ids, "id").count() == 30 and likely.count() < 40
    assert line_dedup._texts(lines, ids).count() == 30
    assert line_dedup._likely(lines, ids.limit(0)).count() == 0


def test_closest_pairs_of_a_round_without_doubling_the_pairs(spark):
    rows = [(1, 2, 9, 1, 2), (1, 3, 4, 1, 3), (2, 3, 7, 2, 3), (3, 4, 8, 3, 4), (2, 4, 8, 2, 4)]
    pairs = spark.createDataFrame(rows, "a long, b long, gap int, own long, other long")
    chosen = near_dedup._chosen(pairs, 1)
    assert {(r.a, r.b) for r in chosen.collect()} == {(1, 3), (2, 3), (2, 4)}
    assert "Generate" not in chosen._jdf.queryExecution().toString()
    assert {(r.a, r.b) for r in near_dedup._untried(pairs, chosen).collect()} == {(1, 2), (3, 4)}


def test_crowded_regions_are_not_read_again(spark, monkeypatch):
    base = prose(5, 90)
    texts = [(k, edited(base, 0.06 + 0.0005 * k, 40 + k)) for k in range(60)]
    read = []
    plain = near_dedup.neighbours
    monkeypatch.setattr(near_dedup, "neighbours", lambda forest, *a, **k: read.append(forest) or plain(forest, *a, **k))
    found = near_dedup.near_duplicates(documents(spark, texts), width=2)
    want, _ = near_components(texts, 2)
    assert {r.doc_id: r.component_id for r in found.collect()} == want
    fullest = [max(r["count"] for r in forest.groupBy("root").count().collect()) for forest in read]
    assert fullest[0] > near_dedup.NEIGHBOURS + 1 >= fullest[1]
