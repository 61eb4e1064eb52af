"""Small tables and plain versions of the operators to hold them against."""

import re
from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def documents(spark, texts, schema="doc_id long, text string", extra=()):
    return spark.createDataFrame([(i, t, *extra) for i, t in texts], schema)


def rows(df, *keys):
    return sorted((tuple(r) for r in df.select(*keys).collect()), key=repr) if keys else sorted(map(tuple, df.collect()), key=repr)


def base_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def components(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def shingles(text, width):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(width)]))


def near_components(texts, width):
    sets = {i: shingles(t, width) for i, t in texts}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return components(links, sets), sets


def kept_bytes(texts, length):
    """doc_id to (bytes, removed, spans, what is left) for texts in order of id."""
    seen, out = set(), {}
    for i, text in sorted(texts):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            if raw[at : at + length] in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(raw[at : at + length])
        spans = sum(1 for at in range(len(gone)) if gone[at] and (at == 0 or not gone[at - 1]))
        out[i] = (len(raw), sum(gone), spans, bytes(c for c, g in zip(raw, gone) if not g))
    return out
