"""Main text of web pages: flat text blocks judged by a small decision tree."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: A comment, a raw element up to its end, or a tag; what lies between is text.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|select|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?/](?:[^>]*)(?:>|\Z)",
    re.S | re.I,
)
#: One attribute after another, so that names are never looked for in values or in longer names.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?|[\"'/=]")
_TELLING = frozenset("class id role hidden aria-hidden".split())
_NAME_PARTS = re.compile(r"[a-z]+")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr math mi mn mo mrow ms mtext msub msup msubsup mfrac msqrt".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SHELL_TAGS = frozenset("nav footer aside form head menu button dialog fieldset".split())
_SHELL_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment comments respond "
    "reply replies disqus menu nav navbar navigation breadcrumb breadcrumbs sidebar footer share sharing social "
    "related recommended recommendations newsletter subscribe signup login popup modal overlay widget cookie cookies "
    "consent gdpr pagination pager search contentinfo complementary".split()
)
#: Names that tell a page's frame only where no article is open.
_FRAME_NAMES = frozenset("header masthead banner notice notices notification alert topbar toolbar copyright legal".split())

#: Names that in an article may as well tell what a part is about: there the tree decides.
_TOPICS = frozenset("social sharing share search widget menu promotion consent".split())
#: Last parts of names that tell readers' comments where no article is open.
_READERS = frozenset("comment comments disqus replies respond".split())

#: First parts of names that tell how a page is laid out around such a part.
_LAYOUT = frozenset("has no with without content main page".split())

FEATURES = (
    "words", "link_density", "previous_words", "previous_link_density", "next_words",
    "next_link_density", "in_shell", "in_article", "hinted",
)

#: Labelled blocks without a hint: the other features above, then 1 for main text.
_UNHINTED = (
    # inside an article: any length, with and without links
    (62, 0.0, 40, 0.0, 55, 0.0, 0, 1, 1), (8, 0.0, 0, 0.0, 70, 0.0, 0, 1, 1), (1, 0.0, 30, 0.0, 1, 0.0, 0, 1, 1),
    (1, 0.0, 1, 0.0, 44, 0.0, 0, 1, 1), (3, 0.0, 5, 1.0, 2, 0.0, 0, 1, 1), (25, 0.9, 30, 0.0, 12, 0.0, 0, 1, 1),
    (2, 1.0, 20, 0.0, 20, 0.0, 0, 1, 1), (14, 0.3, 9, 0.0, 4, 0.0, 0, 1, 1), (90, 0.1, 3, 1.0, 12, 0.0, 0, 1, 1),
    (5, 0.0, 80, 0.0, 9, 0.2, 0, 1, 1), (33, 0.0, 12, 0.0, 6, 0.0, 0, 1, 1), (2, 0.0, 9, 0.0, 2, 0.0, 0, 1, 1),
    # the page's shell, in or outside an article
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0), (2, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0), (7, 0.0, 1, 1.0, 9, 0.0, 1, 0, 0),
    (45, 0.0, 60, 0.0, 0, 0.0, 1, 0, 0), (12, 0.4, 70, 0.0, 0, 0.0, 1, 0, 0), (9, 0.0, 80, 0.0, 0, 0.0, 1, 0, 0),
    (38, 0.0, 52, 0.0, 41, 0.0, 1, 1, 0), (4, 0.5, 60, 0.0, 33, 0.0, 1, 1, 0), (18, 0.0, 22, 0.0, 15, 0.0, 1, 1, 0),
    (120, 0.0, 90, 0.0, 20, 0.0, 1, 1, 0), (1, 0.0, 44, 0.0, 2, 0.0, 1, 1, 0), (64, 0.2, 5, 1.0, 70, 0.0, 1, 0, 0),
    # no article in the page: long blocks with few links are text, and short ones between them
    (48, 0.0, 50, 0.0, 61, 0.0, 0, 0, 1), (31, 0.1, 4, 1.0, 40, 0.0, 0, 0, 1), (75, 0.0, 8, 0.0, 5, 0.6, 0, 0, 1),
    (22, 0.2, 30, 0.0, 26, 0.0, 0, 0, 1), (6, 0.0, 44, 0.0, 38, 0.0, 0, 0, 1), (9, 0.0, 70, 0.0, 51, 0.1, 0, 0, 1),
    (27, 0.0, 0, 0.0, 33, 0.0, 0, 0, 1), (40, 0.3, 60, 0.0, 2, 1.0, 0, 0, 1), (3, 0.0, 35, 0.0, 29, 0.0, 0, 0, 1),
    (40, 0.0, 1, 1.0, 2, 0.0, 0, 0, 1), (28, 0.0, 2, 1.0, 3, 0.0, 0, 0, 1), (65, 0.1, 3, 1.0, 4, 1.0, 0, 0, 1),
    (24, 0.0, 6, 0.0, 5, 0.0, 0, 0, 1), (35, 0.2, 7, 0.5, 6, 1.0, 0, 0, 1), (50, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1),
    # no article: links, and short blocks beside short ones
    (5, 1.0, 4, 1.0, 6, 1.0, 0, 0, 0), (2, 1.0, 60, 0.0, 3, 1.0, 0, 0, 0), (12, 0.8, 9, 0.7, 40, 0.0, 0, 0, 0),
    (30, 0.9, 50, 0.0, 44, 0.0, 0, 0, 0), (3, 0.0, 2, 1.0, 4, 0.0, 0, 0, 0), (7, 0.0, 5, 0.0, 0, 0.0, 0, 0, 0),
    (4, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0), (10, 0.5, 3, 1.0, 2, 1.0, 0, 0, 0), (6, 0.0, 48, 0.0, 0, 0.0, 0, 0, 0),
    (8, 0.0, 4, 1.0, 1, 1.0, 0, 0, 0), (45, 0.6, 3, 1.0, 5, 1.0, 0, 0, 0), (5, 0.2, 3, 0.0, 6, 0.0, 0, 0, 0),
)
#: Blocks under a name of which a part alone is a frame's: in an article that says nothing, else
#: short and linked ones go, wherever they stand.
_HINTED = (
    (62, 0.0, 40, 0.0, 55, 0.0, 0, 1, 1), (1, 0.0, 30, 0.0, 1, 0.0, 0, 1, 1), (25, 0.9, 30, 0.0, 12, 0.0, 0, 1, 1),
    (38, 0.0, 52, 0.0, 41, 0.0, 1, 1, 0), (12, 0.0, 70, 0.0, 0, 0.0, 1, 0, 0), (64, 0.2, 5, 1.0, 70, 0.0, 1, 0, 0),
    (48, 0.0, 50, 0.0, 61, 0.0, 0, 0, 1), (31, 0.1, 4, 1.0, 40, 0.0, 0, 0, 1), (28, 0.0, 2, 1.0, 3, 0.0, 0, 0, 1),
    (40, 0.0, 60, 0.0, 0, 0.0, 0, 0, 1), (65, 0.1, 3, 1.0, 4, 1.0, 0, 0, 1), (24, 0.0, 6, 0.0, 5, 0.0, 0, 0, 1),
    (6, 0.0, 44, 0.0, 38, 0.0, 0, 0, 0), (12, 0.0, 70, 0.0, 40, 0.0, 0, 0, 0), (18, 0.2, 50, 0.0, 30, 0.0, 0, 0, 0),
    (3, 0.0, 36, 0.0, 0, 0.0, 0, 0, 0), (45, 0.6, 40, 0.0, 50, 0.0, 0, 0, 0), (5, 1.0, 60, 0.0, 60, 0.0, 0, 0, 0),
)
#: Blocks of an article under a name that may be a frame's or a topic: links tell which.
_TOPICAL = (
    (62, 0.0, 40, 0.0, 55, 0.0, 0, 1, 1), (3, 0.0, 30, 0.0, 8, 0.0, 0, 1, 1), (30, 0.2, 30, 0.0, 12, 1.0, 0, 1, 1),
    (1, 0.0, 9, 0.0, 0, 0.0, 0, 1, 1), (18, 0.3, 2, 1.0, 3, 1.0, 0, 1, 1), (120, 0.1, 6, 0.0, 70, 0.0, 0, 1, 1),
    (2, 1.0, 40, 0.0, 2, 1.0, 0, 1, 0), (12, 0.8, 60, 0.0, 0, 0.0, 0, 1, 0), (30, 0.9, 4, 0.0, 44, 0.0, 0, 1, 0),
    (5, 0.6, 1, 1.0, 50, 0.0, 0, 1, 0), (62, 0.7, 40, 0.0, 55, 0.0, 0, 1, 0), (38, 0.0, 52, 0.0, 41, 0.0, 1, 1, 0),
)
LABELLED = tuple(
    (*row[:-1], hint, row[-1]) for hint, rows in enumerate((_UNHINTED, _HINTED, _TOPICAL)) for row in rows
)


@dataclass
class Node:
    """A split of a decision tree, or a leaf where ``feature`` is negative."""

    feature: int = -1
    limit: float = 0.0
    keep: bool = False
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Node:
    """Binary tree by Gini impurity; splits stand halfway between neighbouring values."""
    share = y.mean() if len(y) else 0.0
    if depth == 0 or share in (0.0, 1.0):
        return Node(keep=bool(share >= 0.5))
    best = (share * (1 - share) * len(y) - 1e-9, -1, 0.0)
    # flags first: of equal splits the first stays
    for f in sorted(range(x.shape[1]), key=lambda f: -f):
        values = np.unique(x[:, f])
        for limit in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= limit
            cost = sum(len(part) * part.mean() * (1 - part.mean()) for part in (y[low], y[~low]))
            if cost < best[0] - 1e-9:
                best = (cost, f, float(limit))
    _, f, limit = best
    if f < 0:
        return Node(keep=bool(share >= 0.5))
    low = x[:, f] <= limit
    return Node(f, limit, low=grow(x[low], y[low], depth - 1), high=grow(x[~low], y[~low], depth - 1))


def train(labelled=LABELLED) -> Node:
    rows = np.array(labelled, float)
    return grow(rows[:, :-1], rows[:, -1])


def decide(tree: Node, x: tuple) -> bool:
    while tree.feature >= 0:
        tree = tree.low if x[tree.feature] <= tree.limit else tree.high
    return tree.keep


def _shell_of(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, int]:
    """Whether an element is shell by its tag or hidden, shell by a whole name, or has a hint of it
    (2: by a whole name that may be a topic of the article).

    An ``article`` or ``main`` is no shell by its names. In an article ids are places to link to,
    except those of a ``div``.
    """
    hard = tag in _SHELL_TAGS or tag == "header" and not in_article
    named, hint = False, 0
    if not attrs or hard or tag in ("html", "body"):
        return hard, named, hint
    for name, value in _ATTRIBUTE.findall(attrs):
        name = name.lower()
        if name not in _TELLING:
            continue
        if name == "hidden" or name == "aria-hidden" and "true" in value.lower():
            return tag != "main", False, 0
        if tag in ("article", "main"):
            continue
        for token in value.lower().strip("\"'").split():
            parts = _NAME_PARTS.findall(token)
            names = _SHELL_NAMES if in_article else _SHELL_NAMES | _FRAME_NAMES
            if token in names and (name != "id" or not in_article or tag == "div"):
                if in_article and token in _TOPICS:
                    hint = 2
                else:
                    named = True
            elif not names.isdisjoint(parts) and parts[0] not in _LAYOUT:
                if not in_article and parts[-1] in _READERS:
                    named = True
                hint = max(hint, 1)
    return hard, named, hint


def blocks(page: str) -> list[tuple[str, int, int, bool, bool, int]]:
    """Flat text blocks in page order: text, words, words in links, in the shell, in an article, hinted."""
    found: list[tuple[str, int, int, bool, bool, int]] = []
    # tag, and whether it or one around it is shell by tag, shell by name, an article, hinted
    open_tags: list[tuple[str, bool, bool, bool, int]] = []
    parts: list[str] = []
    linked, links, shell, article, hinted = 0, 0, False, False, 0

    def close() -> None:
        nonlocal parts, linked
        words = "".join(parts).split()
        if words:
            found.append((" ".join(words), len(words), linked, shell, article, hinted))
        parts, linked = [], 0

    def text(segment: str) -> None:
        nonlocal linked
        if segment:
            segment = html.unescape(segment)
            parts.append(segment)
            if links:
                linked += len(segment.split())

    at = 0
    for m in _MARKUP.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                links = max(0, links - 1) if m["end"] else links + 1
            if tag in _VOID or tag == "a" or not m["attrs"] and not m["end"]:
                continue
        else:
            close()
            links = 0
        if m["end"]:
            depth = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == tag), -1)
            if depth >= 0:
                del open_tags[depth:]
        elif tag not in _VOID:
            if tag in ("article", "main", "body"):  # a frame left open ends here
                while open_tags and open_tags[-1][0] in ("nav", "header", "footer", "head", "ul", "ol", "li"):
                    open_tags.pop()
                if not open_tags or not open_tags[-1][3]:  # what holds an article is no shell by its name
                    open_tags = [(t, hard, False, inner, 0) for t, hard, _, inner, _ in open_tags]
            _, hard, named, inner, hint = open_tags[-1] if open_tags else ("", False, False, False, 0)
            own = _shell_of(tag, m["attrs"], inner)
            if tag in _INLINE:  # no hint cuts a sentence, and in code a "comment" is text
                own = (own[0], own[1] and not any(t[0] == "pre" for t in open_tags), 0)
            if tag in _INLINE and any(own) and not (hard or named):
                close()
            inner = inner or tag in ("article", "main")
            open_tags.append((tag, hard or own[0], named or own[1], inner, max(hint, own[2])))
        _, hard, named, inner, hint = open_tags[-1] if open_tags else ("", False, False, False, 0)
        if (hard or named, inner, hint) != (shell, article, hinted):
            close()
            shell, article, hinted = hard or named, inner, hint
    text(page[at:])
    close()
    return found


def main_text(page: str, tree: Node) -> str:
    """Blocks that the tree keeps, joined by a line feed."""
    flat = blocks(page)
    edge = (0, 0.0)
    shape = [edge, *[(n, links / n) for _, n, links, *_ in flat], edge]
    kept = [
        block[0]
        for i, block in enumerate(flat, 1)
        if decide(tree, (*shape[i], *shape[i - 1], *shape[i + 1], *block[3:]))
    ]
    return "\n".join(kept)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text`` of every row.

    Text outside tags is cut into blocks at block-level tags; character references are decoded
    and white space inside a block, ``<br>`` included, becomes one space. A tree trained on
    ``LABELLED`` judges a block by its words and link density, those of its neighbours, and
    whether it stands in the page's shell (menus, headers, footers, sidebars, adverts, forms,
    notices, comments, hidden parts) or in an article. A class, role or id tells the shell if a
    whole name of it does; a part of a name, or inside an article a name that may be its topic, is
    a hint the tree weighs. Rows are handled alone: a null page or
    one without main text gives an empty text, repeated rows give equal rows, ids and urls pass
    through, other columns are not read.
    """
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 8_000_000):
            texts = [main_text(x, tree) if x else "" for x in batch.column("html").to_pylist()]
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.col(page).cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string")
