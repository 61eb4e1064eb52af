"""Secrets in texts: fixed token shapes, and literals that sensitive names are given."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import encoded, slices
from .words import byte_table

#: Kinds in the order in which spans of equal starts are listed; the last is found by lexing.
KINDS = ("assign", "access", "hex", "literal")
SPANS = "array<struct<kind: string, start: bigint, end: bigint, name: string, score: double>>"

# --- fixed values: token shapes --------------------------------------------------------------

ASSIGNED = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
SHORTEST_ASSIGNED, SHORTEST_HEX = 6, 24

# --- fixed values: names and literals ----------------------------------------------------------

SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "passphrase": 3.0, "passcode": 3.0, "pwd": 3.0, "pass": 2.0,
    "secret": 3.0, "secrets": 3.0, "credential": 3.0, "credentials": 3.0, "creds": 3.0,
    "token": 3.0, "apikey": 3.0, "jwt": 3.0, "bearer": 2.0, "authorization": 2.0, "auth": 2.0,
    "pin": 2.0, "otp": 2.0, "salt": 2.0, "signature": 1.0, "cookie": 1.0, "session": 1.0,
}
#: Words before "key" that make it a secret one.
KEY_OWNERS = frozenset(
    "api access private secret auth encryption signing client master service account storage deploy admin".split()
)
#: Last words of names that speak about a secret without holding it.
ABOUT = frozenset(
    "id name file path dir url uri field label type kind length len size count prompt hint policy expiry expires "
    "ttl header regex pattern format column table version status enabled required".split()
)
PLACEHOLDER = re.compile(
    r"(?i)\A(?:x+|\*+|\.+|-+|none|null|nil|true|false|undefined|todo|tbd|changeme|change[_-]me|placeholder|"
    r"dummy|example|sample|redacted|password|secret|token|your[_-].*|my[_-].*|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|%s)\Z"
)
SHORTEST_LITERAL = 6

# --- lexing ------------------------------------------------------------------------------------

_TARGET = re.compile(
    r"""(?<![\w$.\-])(?P<name>[A-Za-z_$][\w$\-]*(?:(?:\.|->|::)[\w$\-]+)*)["'`]?(?:\][ \t]*)?"""
    r"""(?:[ \t]*:[ \t]*[A-Za-z_][\w.\[\]]*(?=[ \t]*=[^=]))?[ \t]*(?P<op>:=|=>|\?=|\+=|=(?![=~])|:(?![:=/]))[ \t]*""",
    re.ASCII,
)
_STRING = re.compile(
    r"""(?:[rRbBfFuU]{1,2})?(?:\"\"\"(?P<d3>(?:[^\\"]|\\.|"(?!""))*)\"\"\"|'''(?P<s3>(?:[^\\']|\\.|'(?!''))*)'''"""
    r"""|"(?P<d>(?:[^"\\\n]|\\.)*)"|'(?P<s>(?:[^'\\\n]|\\.)*)'|`(?P<b>(?:[^`\\\n]|\\.)*)`)""",
    re.S,
)
_REFERENCE = re.compile(r"\$\{?(?P<var>[A-Za-z_]\w*)\}?|(?P<name>[A-Za-z_$][\w$]*(?:(?:\.|->|::)[\w$]+)*)(?![\w\-+/=@!$%^*~])", re.ASCII)
_CALL = re.compile(r"[A-Za-z_$][\w$.:]*\([ \t]*", re.ASCII)
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>|&#]+""")
_LOOKUP = re.compile(r"(?i)env|get|prop|input|prompt|read|fetch|load|find|require|import")
#: What stands between the parts of a value, on its line or, in brackets, on several.
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|&|\.(?=[ \t]*[\"'$]))[ \t]*(?:\\?\n[ \t]*)?")
_NEXT = re.compile(r"[ \t]*(?:\\\n[ \t]*)?(?=[rRbBfFuU]{0,2}[\"'])")
_NEXT_INSIDE = re.compile(r"\s*,?\s*(?=[rRbBfFuU]{0,2}[\"'])")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_TEMPLATE = re.compile(r"\$\{(?P<a>[A-Za-z_]\w*)\}|\{(?P<b>[A-Za-z_]\w*)\}", re.ASCII)


@dataclass(frozen=True)
class Piece:
    """A literal, or a part of one, where it stands in the text."""

    start: int
    end: int
    text: str


def _own(name: str) -> str:
    """The last part of a dotted name, which is the one that is given the value."""
    return re.split(r"\.|->|::", name)[-1]


def assignments(text: str) -> Iterator[tuple[str, tuple[Piece, ...]]]:
    """Names with the literals they are given, in order, constants put in where they are named.

    Quoted, bare and concatenated values are read, as are the arguments of a call around them; a
    name met in a value, also as ``${name}`` or ``{name}`` in a string, stands for what it was
    given last before. ``+=`` adds to that. Ends are exclusive.
    """
    known: dict[str, tuple[Piece, ...]] = {}
    at = 0
    while found := _TARGET.search(text, at):
        pieces, end = _value(text, found.end(), known)
        name = found["name"]
        if found["op"] == "+=":
            pieces = known.get(_own(name), ()) + pieces
        if pieces:
            known[_own(name)] = pieces
            yield name, pieces
        # a value may hold the next name: {"a": b = "c"}
        at = max(found.end(), end) if pieces and end > found.end() else found.end()


def _value(text: str, at: int, known: dict[str, tuple[Piece, ...]]) -> tuple[tuple[Piece, ...], int]:
    pieces: tuple[Piece, ...] = ()
    inside = False
    while True:
        while (opened := text[at : at + 1]) and opened in "([":
            at, inside = at + 1, True
        term, at, quoted = _term(text, at, known)
        if term is None:
            return pieces, at
        pieces += term
        joined = _JOIN.match(text, at) or (quoted and (_NEXT_INSIDE if inside else _NEXT).match(text, at))
        if not joined:
            return pieces, at
        at = joined.end()


def _term(text: str, at: int, known: dict[str, tuple[Piece, ...]]):
    """A value's next part: its pieces (none if it can't be read), the end, and if it is quoted."""
    if string := _STRING.match(text, at):
        group = string.lastgroup
        start, end = string.span(group)
        parts: list[Piece] = []
        last = start
        for hole in _TEMPLATE.finditer(text, start, end):
            inner = known.get(hole["a"] or hole["b"])
            if inner:
                if hole.start() > last:
                    parts.append(Piece(last, hole.start(), text[last : hole.start()]))
                parts += inner
                last = hole.end()
        if end > last:
            parts.append(Piece(last, end, text[last:end]))
        return tuple(parts), string.end(), True
    if call := _CALL.match(text, at):
        # what a call is given passes through it, unless it looks something up
        if _LOOKUP.search(call.group()):
            return (), call.end(), False
        return _value(text, call.end(), known) + (False,)
    reference = _REFERENCE.match(text, at)
    if reference:
        name = _own(reference["var"] or reference["name"])
        if name in known:
            return known[name], reference.end(), False
        if reference["var"] or reference.group().count(".") or "->" in reference.group() or "::" in reference.group():
            return (), reference.end(), False
    if bare := _BARE.match(text, at):
        # marks that end a sentence aren't part of a bare value
        word = bare.group().rstrip(".:!?")
        return ((Piece(at, at + len(word), word),) if word else ()), bare.end(), False
    return None, at, False


def name_score(name: str) -> float:
    """How much a name promises a secret; 0 where it doesn't."""
    words = [w.lower() for part in re.split(r"[^A-Za-z0-9]+", name) for w in _WORD.findall(part)]
    if not words or words[-1] in ABOUT:
        return 0.0
    score = max(SENSITIVE.get(w, 0.0) for w in words)
    for before, word in zip(words, words[1:]):
        if word in ("key", "keys") and before in KEY_OWNERS:
            score = max(score, 3.0)
    return score


def literal_score(value: str) -> float:
    """How much a value looks drawn at random; below 0 where it can't be a secret."""
    if len(value) < SHORTEST_LITERAL or re.search(r"\s", value) or PLACEHOLDER.match(value):
        return -math.inf
    counts = Counter(value)
    bits = -sum(n * math.log2(n / len(value)) for n in counts.values())
    classes = sum(any(test(c) for c in counts) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(3.0, bits / 16) + (classes - 1) / 2


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGNED.finditer(text) if m.end(2) - m.start(2) >= SHORTEST_ASSIGNED]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def lexed_spans(text: str, threshold: float, taken: list[tuple[str, int, int]]) -> list[tuple]:
    """Literals that sensitive names are given, where no span taken holds them already."""
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for name, pieces in assignments(text):
        about = name_score(_own(name))
        if about <= 0:
            continue
        # judged whole, reported piece by piece
        score = about + literal_score("".join(p.text for p in pieces))
        if score >= threshold:
            for p in pieces:
                best[p.start, p.end] = max(best.get((p.start, p.end), (0.0, name)), (score, name), key=lambda x: x[0])
    starts = sorted((s, e) for _, s, e in taken)
    reach, furthest = [], 0
    for _, e in starts:
        furthest = max(furthest, e)
        reach.append(furthest)
    begins = np.array([s for s, _ in starts])
    out = []
    for (start, end), (score, name) in best.items():
        held = int(np.searchsorted(begins, start, "right"))
        if not held or reach[held - 1] < end:
            out.append(("literal", start, end, name, score))
    return out


def _worth_reading(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Texts that may hold a token shape, and those that may hold an assignment."""
    data, offsets = encoded(batch.column("text"))
    base = np.zeros(batch.num_rows, bool)
    lexed = base.copy()
    if len(data) == 0:
        return base, lexed

    def mark(flags: np.ndarray, places: np.ndarray) -> None:
        flags[np.searchsorted(offsets, places, "right") - 1] = True

    digits = byte_table(b"0123456789abcdef")[data].astype(np.int8)
    edges = np.flatnonzero(np.diff(digits, prepend=0, append=0))
    begins, ends = edges[::2], edges[1::2]
    # a run over the edge of two texts only costs a look at both
    for places in (begins, ends - 1):
        mark(base, places[ends - begins >= SHORTEST_HEX])
    lower = data | np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    for raw, words in ((lower.tobytes(), KEYWORDS), (data.tobytes(), (b"AKIA",))):
        for word in words:
            hits, at = [], raw.find(word)
            while at >= 0:
                hits.append(at)
                at = raw.find(word, at + 1)
            mark(base, np.array(hits, np.int64))
    mark(lexed, np.flatnonzero((data == ord("=")) | (data == ord(":"))))
    return base, lexed


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 4.0) -> DataFrame:
    """``doc_id, spans`` for every row: kind, start, end (code points, end exclusive), name, score.

    Fixed shapes come first: what follows password, secret, token and the like, access key ids and
    long hexadecimal runs; their name is null and their score 1. Then assignments are lexed
    (source code, shell, JSON, YAML, INI), constants are put in for the names that stand for
    them, and a literal is a secret if its target's name and its own look together reach
    ``threshold``: from 2 to 3 for the name, up to 4.5 for length, variety and kinds of characters.
    Literals inside a span of a fixed shape aren't reported again.

    Null and empty texts have no spans; texts are read whole at any length; rows that share an id,
    or have none, are judged each by itself; an empty table gives no rows; other columns aren't
    read. Spans stand by start, then kind, then end.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    spans = pa.list_(pa.struct([
        ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64()),
    ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8_000_000):
            base, lexed = _worth_reading(batch)
            column, out = batch.column("text"), []
            for i in range(batch.num_rows):
                found: list[tuple] = []
                if base[i] or lexed[i]:
                    whole = column[i].as_py()
                    shapes = base_spans(whole) if base[i] else []
                    found = [(*s, None, 1.0) for s in shapes]
                    if lexed[i]:
                        found += lexed_spans(whole, threshold, shapes)
                    found.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
                out.append([dict(zip(("kind", "start", "end", "name", "score"), s)) for s in found])
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, spans)], ["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, spans {SPANS}")
