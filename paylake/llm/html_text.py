"""Main text of web pages: flat blocks, classified by a decision tree.

A page is cut into flat text blocks at block-level tags. Each block has its word count and
link density, those of its two neighbours, whether it is a paragraph or heading and ends as a
sentence does, and what the nearest container that tells something says. A decision tree
trained on the small ``labelled_table`` says which blocks are main text; most of the table is
blocks of which no container tells anything. White space inside a block becomes one space, and
blocks are joined by one space.

A container tells by its tag or by the names in its class, id and role. A name is told by its
last part: ``legal-notice`` is a notice, ``legal-analysis`` only hints at one, and there the
shape of the block decides. An article or main element outweighs what stands around it, but
for navigation, asides, adverts and comments.

A null or empty page, or one without main text, gives the empty string. Pages are handled
one by one: repeated rows and null ids come out as they went in; columns other than the
three named are not looked at. Pages and blocks of any length are read whole, in one pass; a
tag that is not closed, or not quoted to its end, is text or ends at the next tag.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import slices

# A comment, a raw element with its content, or a tag; the first two end at the page's end if
# open. No tag reaches over a "<" outside quotes, so a start that fails has looked at little.
_ATTRIBUTES = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+"
_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(script|style|title|textarea|noscript|template|svg|select|iframe|object)\b"
    rf"{_ATTRIBUTES}>(?:.*?</\1\s*>|.*)"
    rf"|<(/?)([a-z][a-z0-9-]*)({_ATTRIBUTES})>"
    r"|<[!?/][^<>]*>",
    re.DOTALL | re.IGNORECASE,
)
_HINT = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.IGNORECASE)
_SPACE = re.compile(r"[\x20\t\n\r\x0b\f\xa0]+|\s+")

# HTML's inline elements; any other tag ends a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q"
    " rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset(
    "article aside blockquote body button center dd details dialog div dl dt fieldset figure footer"
    " form header li main menu nav ol section table tbody td tr ul".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
# Do not begin another block of their own kind: what follows belongs to the block before.
BREAKS = frozenset("br hr".split())
# What a container is by its tag, and by the names in its class, id and role. No article inside
# outweighs the first of each.
FIRM_TAGS = frozenset("nav aside menu dialog".split())
BOILER_TAGS = frozenset("form fieldset button".split())
EDGE_TAGS = frozenset("header footer".split())
FIRM_NAMES = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|comments?|commentlist|respond|reply|replies|disqus|"
    r"responses?|discussion|cookies?|consent|popup|modal|newsletter|related|recommend\w*|"
    r"outbrain|taboola|navigation|complementary|alertdialog"
)
BOILER_NAMES = re.compile(
    r"banner|nav\w*|menu\w*|sidebar\w*|widget\w*|breadcrumb\w*|notice\w*|alert|subscribe|signup|"
    r"login|search|share\w*|sharing|social\w*|tags|tagcloud|taglist|pagination|pager|toolbar|skip|"
    r"footer\w*|colophon|copyright|masthead|topbar|legal|disclaimer|rail|contentinfo|form|dropdown"
)
MAIN_NAMES = re.compile(r"article\w*|content|main|post|story|entry|bodytext|prose|text")
# An article element is boilerplate only as a reader's comment or another page's teaser.
ARTICLE_NAMES = re.compile(r"ads?|advert\w*|sponsor\w*|promo\w*|comments?|reply|related|teaser")
# Say something of the page's state, not of the element: "has-sidebar", "no-menu".
_STATES = frozenset("has with without no is js".split())
_PARTS = re.compile(r"[_-]+")

# What a container says: nothing, that it holds main text, that it may be boilerplate, that it
# is, that it is whatever article is inside, that it is the page's head or foot.
NOTHING, MAIN, HINT, BOILER, FIRM, EDGE = range(6)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    says: int  # what the nearest container that says something says
    hint: int  # 1 if one nearer than that may be boilerplate
    paragraph: int  # 1 in a paragraph or heading


def _kind(tag: str, attributes: str, inside: bool) -> int:
    """What a container says by itself."""
    hints = " ".join(m.group(2).strip("\"'") for m in _HINT.finditer(attributes or "")).lower()
    names = [parts for x in hints.split() if (parts := _PARTS.split(x))[0] not in _STATES]
    if tag == "article":
        told = any(ARTICLE_NAMES.fullmatch(p) for parts in names for p in parts)
        return FIRM if told else MAIN
    if tag in FIRM_TAGS:
        return FIRM
    if tag not in ("body", "main"):
        if any(FIRM_NAMES.fullmatch(p) for parts in names for p in parts):
            return FIRM
        if tag in BOILER_TAGS or any(
            BOILER_NAMES.fullmatch(parts[-1]) or BOILER_NAMES.fullmatch("".join(parts))
            for parts in names
        ):
            return BOILER
    if tag in EDGE_TAGS or any("header" in parts for parts in names):
        return NOTHING if inside and tag != "footer" else EDGE
    if tag == "main" or any(MAIN_NAMES.fullmatch(p) for parts in names for p in parts):
        return MAIN
    if any(BOILER_NAMES.fullmatch(p) for parts in names for p in parts) and tag != "body":
        return HINT
    return NOTHING


def _within(around: tuple[int, int], kind: int, tag: str) -> tuple[int, int]:
    """What holds inside a container, from what holds around it: (says, hint)."""
    says, hint = around
    if kind == NOTHING:
        return around
    if kind == HINT:
        return says, 1
    if kind == MAIN:
        # Names do not outweigh what a container around them is; an article does, if it may.
        stays = says == FIRM or (says in (BOILER, EDGE) and tag not in ("article", "main"))
        return (says, hint) if stays else (MAIN, 0)
    return (FIRM, 0) if FIRM in (kind, says) else (kind, 0)


def blocks_of(page: str) -> list[Block]:
    """The page's flat text blocks in order."""
    out: list[Block] = []
    pieces: list[str] = []
    linked_pieces: list[str] = []
    stack: list[tuple[str, tuple[int, int]]] = []  # each open container, and what held around it
    opened: Counter[str] = Counter()
    now = own = (NOTHING, 0)  # own: also what the block's own tag says
    links = paragraph = 0

    def close() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(pieces))).strip()
        if text:
            linked = len(entities.unescape(" ".join(linked_pieces)).split())
            words = len(text.split())
            out.append(Block(text, words, min(linked, words), *own, paragraph))
        pieces.clear()
        linked_pieces.clear()

    def add(text: str) -> None:
        pieces.append(text)
        if links:
            linked_pieces.append(text)

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m.group(3) or "").lower()
        if not tag:
            if (m.group(1) or "").lower() == "title":
                close()
            continue
        closing = m.group(2) == "/"
        if tag == "a":
            links = 0 if closing else 1
        if tag in INLINE:
            continue
        close()
        if tag in BREAKS:
            continue
        paragraph = int(tag in PARAGRAPHS and not closing)
        own = now
        if tag not in CONTAINERS:
            if not closing and m.group(4):
                kind = _kind(tag, m.group(4), now[0] == MAIN)
                if kind in (BOILER, FIRM):
                    own = _within(now, kind, tag)
            continue
        if closing:
            if opened[tag]:
                while True:
                    last, now = stack.pop()
                    opened[last] -= 1
                    if last == tag:
                        break
            links = 0
        else:
            if tag == "li" and stack and stack[-1][0] == "li":
                _, now = stack.pop()  # an open item ends where the next begins
                opened["li"] -= 1
            stack.append((tag, now))
            opened[tag] += 1
            if tag != "li":
                now = _within(now, _kind(tag, m.group(4), now[0] == MAIN), tag)
        own = now
    if at < len(page):
        add(page[at:])
    close()
    return out


FEATURES = (
    "words",
    "link_density",
    "words_before",
    "link_density_before",
    "words_after",
    "link_density_after",
    "paragraph",
    "ends_sentence",
    "boiler",
    "inside",
    "hint",
)


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block; a neighbour that is missing counts as empty."""
    words = np.array([0, *(b.words for b in blocks), 0], float)
    density = np.array([0, *(b.linked / max(b.words, 1) for b in blocks), 0], float)
    own = np.array(
        [
            (b.paragraph, b.text[-1] in SENTENCE_ENDS, b.says >= BOILER, b.says == MAIN, b.hint)
            for b in blocks
        ],
        float,
    )
    around = [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]]
    return np.column_stack([*around, own]) if blocks else np.empty((0, len(FEATURES)))


SENTENCE_ENDS = frozenset(".!?:;\"'”»)")


# Blocks labelled by reading them where no container tells what they are: (label, words, link
# density, the block before, the block after, paragraph or heading, ends a sentence); a
# neighbour is (words, density), and (0, 0.0) is none.
PLAIN = (
    # Paragraphs, long and short, among others and beside headings, captions and lists.
    (1, 48, 0.0, (7, 0.0), (39, 0.0), 1, 1),
    (1, 39, 0.1, (48, 0.0), (64, 0.0), 1, 1),
    (1, 8, 0.0, (39, 0.0), (64, 0.0), 1, 1),
    (1, 3, 0.0, (60, 0.0), (45, 0.0), 1, 1),
    (1, 1, 0.0, (26, 0.0), (31, 0.0), 1, 1),
    (1, 2, 0.0, (35, 0.0), (41, 0.1), 1, 1),
    (1, 18, 0.0, (24, 0.0), (8, 0.6), 1, 1),
    (1, 15, 0.1, (5, 0.0), (33, 0.0), 1, 1),
    (1, 12, 0.0, (30, 0.0), (28, 0.2), 1, 1),
    (1, 90, 0.25, (10, 0.0), (2, 1.0), 1, 1),
    (1, 22, 0.0, (0, 0.0), (0, 0.0), 1, 1),
    (1, 14, 0.0, (20, 0.0), (0, 0.0), 1, 1),
    (1, 5, 0.0, (33, 0.0), (26, 0.0), 1, 1),
    (1, 120, 0.1, (3, 0.0), (6, 1.0), 1, 1),
    (1, 14, 0.2, (6, 0.0), (24, 0.0), 1, 1),
    (1, 30, 0.0, (52, 0.0), (9, 0.0), 1, 1),
    (1, 9, 0.0, (70, 0.0), (11, 0.0), 1, 1),
    (1, 6, 0.0, (8, 0.0), (7, 0.0), 1, 1),
    (1, 24, 0.0, (3, 1.0), (18, 0.0), 1, 1),
    (1, 10, 0.0, (1, 1.0), (44, 0.0), 1, 1),
    # Headings: before text, behind a menu, an advert or another heading.
    (1, 4, 0.0, (50, 0.0), (47, 0.0), 1, 0),
    (1, 7, 0.0, (2, 1.0), (48, 0.0), 1, 0),
    (1, 9, 0.0, (8, 0.0), (10, 0.0), 1, 0),
    (1, 10, 0.0, (14, 0.0), (3, 0.0), 1, 0),
    (1, 11, 0.0, (6, 0.0), (16, 0.0), 1, 1),
    (1, 3, 0.0, (9, 0.0), (60, 0.0), 1, 0),
    (1, 12, 0.0, (3, 0.0), (30, 0.0), 1, 0),
    (1, 6, 0.0, (5, 0.0), (12, 0.0), 1, 0),
    # Text that stands in no paragraph, and items of a list with sentences.
    (1, 60, 0.0, (40, 0.0), (52, 0.0), 0, 1),
    (1, 41, 0.05, (6, 0.0), (8, 0.0), 0, 1),
    (1, 33, 0.0, (0, 0.0), (25, 0.0), 0, 1),
    (1, 19, 0.0, (22, 0.0), (17, 0.0), 0, 1),
    (1, 16, 0.0, (28, 0.0), (14, 0.0), 0, 1),
    (1, 35, 0.1, (2, 1.0), (30, 0.0), 0, 1),
    # Menus, lists of links, tags, pages.
    (0, 1, 1.0, (1, 1.0), (1, 1.0), 0, 0),
    (0, 2, 1.0, (1, 1.0), (3, 1.0), 0, 0),
    (0, 1, 1.0, (0, 0.0), (1, 1.0), 0, 0),
    (0, 1, 1.0, (1, 1.0), (9, 0.0), 0, 1),
    (0, 3, 1.0, (2, 1.0), (40, 0.0), 0, 0),
    (0, 8, 1.0, (7, 1.0), (9, 1.0), 0, 0),
    (0, 16, 0.9, (4, 1.0), (5, 1.0), 1, 0),
    (0, 26, 0.8, (3, 1.0), (2, 1.0), 0, 0),
    (0, 4, 1.0, (55, 0.0), (3, 1.0), 1, 0),
    (0, 4, 1.0, (30, 0.0), (50, 0.0), 0, 0),
    (0, 12, 0.7, (0, 0.0), (6, 1.0), 0, 0),
    (0, 1, 1.0, (0, 0.0), (80, 0.0), 0, 0),
    (0, 4, 0.5, (3, 1.0), (0, 0.0), 0, 1),
    (0, 10, 0.6, (5, 1.0), (40, 0.0), 1, 1),
    # Adverts and slogans: a sentence in no paragraph between a menu and a heading.
    (0, 8, 0.0, (1, 1.0), (10, 0.0), 0, 1),
    (0, 6, 0.0, (1, 1.0), (4, 0.0), 0, 1),
    (0, 12, 0.0, (1, 1.0), (8, 0.0), 0, 1),
    (0, 15, 0.0, (2, 1.0), (12, 0.0), 0, 1),
    (0, 3, 0.0, (1, 1.0), (7, 0.0), 0, 1),
    (0, 18, 0.0, (1, 1.0), (6, 0.0), 0, 1),
    (0, 22, 0.0, (1, 1.0), (9, 0.0), 0, 1),
    # Labels, bylines, dates, copyright lines.
    (0, 3, 0.0, (1, 1.0), (2, 1.0), 0, 0),
    (0, 5, 0.0, (2, 1.0), (0, 0.0), 0, 0),
    (0, 2, 0.0, (0, 0.0), (1, 1.0), 0, 0),
    (0, 6, 0.0, (4, 1.0), (3, 0.0), 0, 0),
    (0, 3, 0.0, (6, 0.0), (1, 0.0), 0, 1),
    (0, 1, 0.0, (2, 0.0), (0, 0.0), 0, 0),
    (0, 9, 0.0, (34, 0.0), (0, 0.0), 0, 1),
    (0, 7, 0.2, (48, 0.0), (0, 0.0), 0, 0),
)
# How much a block of which no container tells anything counts for beside one in a container.
PLAIN_WEIGHT = 12


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the training blocks."""
    return _weighted_table()[:2]


def _weighted_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The training blocks, and how much each counts.

    Blocks of the shapes in ``PLAIN`` are also seen in containers. An article's blocks are main
    text and a boilerplate container's are not, whatever their shape. Where a name only hints,
    sentences with few links are main text, if they are long or stand in an article.
    """
    rows, labels, weights = [], [], []

    def see(shape, paragraph, ends, label, weight=1.0, boiler=0, inside=0, hint=0) -> None:
        rows.append((*shape, paragraph, ends, boiler, inside, hint))
        labels.append(label)
        weights.append(weight)

    for label, words, density, before, after, paragraph, ends in PLAIN:
        shape = (words, density, *before, *after)
        sentence = ends and density < 0.3
        see(shape, paragraph, ends, label, PLAIN_WEIGHT)
        see(shape, paragraph, ends, 1, inside=1)
        for hint in (0, 1):
            see(shape, paragraph, ends, 0, boiler=1, hint=hint)
        see(shape, paragraph, ends, int(sentence and (words >= 12 or paragraph)), inside=1, hint=1)
        see(shape, paragraph, ends, int(sentence and words >= 14 and label), hint=1)
    return np.array(rows, float), np.array(labels, float), np.array(weights)


@dataclass
class Node:
    """A leaf has its label in ``leaf``; an inner node goes left up to its threshold."""

    leaf: int | None = None
    feature: int = 0
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int = 12) -> Node:
    """A tree by Gini impurity; ties go to the earlier feature, then the lower threshold."""

    def share(side: np.ndarray) -> float:
        return float(np.average(y[side], weights=weight[side]))

    if depth == 0 or y.min() == y.max():
        return Node(leaf=int(np.average(y, weights=weight) >= 0.5))
    best = (np.inf, 0, 0.0)
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for cut in (values[1:] + values[:-1]) / 2:
            left = x[:, j] <= cut
            spread = sum(weight[s].sum() * share(s) * (1 - share(s)) for s in (left, ~left))
            if spread < best[0] - 1e-9:
                best = (spread, j, float(cut))
    if not np.isfinite(best[0]):
        return Node(leaf=int(np.average(y, weights=weight) >= 0.5))
    side = x[:, best[1]] <= best[2]
    return Node(
        feature=best[1],
        threshold=best[2],
        left=grow(x[side], y[side], weight[side], depth - 1),
        right=grow(x[~side], y[~side], weight[~side], depth - 1),
    )


def classify(tree: Node, x: np.ndarray) -> np.ndarray:
    if tree.leaf is not None:
        return np.full(len(x), tree.leaf, bool)
    out = np.empty(len(x), bool)
    side = x[:, tree.feature] <= tree.threshold
    out[side] = classify(tree.left, x[side])
    out[~side] = classify(tree.right, x[~side])
    return out


@lru_cache(maxsize=1)
def trained_tree() -> Node:
    return grow(*_weighted_table())


def texts_of(pages: list[str]) -> list[str]:
    """The main text of each page."""
    blocks = [blocks_of(p) for p in pages]
    if not any(blocks):
        return [""] * len(pages)
    keep = classify(trained_tree(), np.vstack([features(b) for b in blocks]))
    out, at = [], 0
    for own in blocks:
        kept = keep[at : at + len(own)]
        at += len(own)
        out.append(" ".join(b.text for b, k in zip(own, kept, strict=True) if k))
    return out


SCHEMA = "page_id long, url string, text string, n_chars long"


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: its main text and how many code points that has."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            texts = texts_of(batch["html"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"],
                    batch["url"],
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    ).mapInArrow(extract, SCHEMA)
