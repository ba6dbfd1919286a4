"""Main text of web pages by a tree-structured graphical model with exact sum-product inference.

Every block element and text block of a page is a node that is content or not.  A node's potential comes
from its features: element, words in class, id and role, text length, link share, punctuation; an
edge's potential is one of a few 2 x 2 tables between a node and its parent, by the kind of child.  On
a tree, messages sent once up (leaves to root) and once down give exact marginals, here for all pages
of a batch at once, one depth at a time.  Weights maximise the likelihood of the labelled pages of
`html_pages` (expected against observed feature counts, from the same marginals), with Adam.

A page's text is its text blocks with a marginal of at least 0.5, in page order, joined by one \\n.
Character references are decoded; white space inside a block is one space; nothing is cut or capped.

Defined results: null and empty pages, and pages without content, have an empty text and 0
characters; null ids and urls stay null; repeated rows are read each; other columns are ignored.
No shuffle, no state between rows; a page of any size is read whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablelift.llm.common import slices
from tablelift.llm.html_pages import MARK, labelled_pages
from tablelift.llm.html_tree import BLOCK, CUES, Page, read_page

TAGS = len(BLOCK)
LENGTHS = 12  # powers of two
SHARES = 6  # link share in fifths
TEXT_AT = 0  # feature numbers: text blocks by parent element, length, link share, end
TEXT_LENGTH = TEXT_AT + TAGS
TEXT_LINKS = TEXT_LENGTH + LENGTHS
TEXT_END = TEXT_LINKS + SHARES
ELEMENT_AT = TEXT_END + 2  # elements by element, cues, text length and link share of all below
ELEMENT_CUE = ELEMENT_AT + TAGS
ELEMENT_LENGTH = ELEMENT_CUE + len(CUES)
ELEMENT_LINKS = ELEMENT_LENGTH + LENGTHS
FEATURES = ELEMENT_LINKS + SHARES
PARTS = frozenset(BLOCK.index(t) for t in "article section main div header footer nav aside form table td body".split())
EDGES = 3  # kinds of child: text block, part of the page, other element
STEPS = 250


class Forest(NamedTuple):
    """Nodes of many pages."""

    parent: np.ndarray  # -1 for roots
    depth: np.ndarray
    kind: np.ndarray  # kind of edge to the parent
    feature: np.ndarray  # active features, all nodes in turn
    owner: np.ndarray  # the node of each active feature
    page: np.ndarray


def length_step(n: int) -> int:
    return min(n.bit_length(), LENGTHS - 1)


def forest(pages: Sequence[Page]) -> Forest:
    parent, depth, kind, feature, owner, page_of = [], [], [], [], [], []
    base = 0
    for number, page in enumerate(pages):
        n = len(page.parent)
        below, linked = [0] * n, [0] * n
        for i in range(n - 1, -1, -1):
            below[i] += len(page.text[i])
            linked[i] += page.linked[i]
            if i:
                below[page.parent[i]] += below[i]
                linked[page.parent[i]] += linked[i]
        depths = [0] * n
        for i in range(n):
            up, tag = page.parent[i], page.tag[i]
            if up >= 0:
                depths[i] = depths[up] + 1
            share = min(SHARES - 1, SHARES * linked[i] // max(below[i], 1))
            if tag < 0:
                text = page.text[i]
                active = [TEXT_AT + page.tag[up], TEXT_LENGTH + length_step(len(text)), TEXT_LINKS + share, TEXT_END + (text[-1] in ".!?:\"”")]
                kind.append(0)
            else:
                active = [ELEMENT_AT + tag, ELEMENT_LENGTH + length_step(below[i]), ELEMENT_LINKS + share]
                active += [ELEMENT_CUE + c for c in page.cues[i]]
                kind.append(1 if tag in PARTS else 2)
            feature += active
            owner += [base + i] * len(active)
            parent.append(up + base if up >= 0 else -1)
        depth += depths
        page_of += [number] * n
        base += n
    return Forest(*(np.array(x, np.int64) for x in (parent, depth, kind, feature, owner, page_of)))


class Model(NamedTuple):
    unary: np.ndarray  # FEATURES: log odds of content
    edge: np.ndarray  # EDGES x 2 x 2: parent label, child label


def log_sum(a: np.ndarray) -> np.ndarray:
    """log(exp(a[..., 0]) + exp(a[..., 1]))."""
    return np.logaddexp(a[..., 0], a[..., 1])


def marginals(trees: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of every node, and for non-roots P(parent label, own label), by sum-product."""
    n = len(trees.parent)
    local = np.zeros((n, 2))
    local[:, 1] = np.bincount(trees.owner, model.unary[trees.feature], minlength=n)
    table = model.edge[trees.kind]
    levels = [np.flatnonzero(trees.depth == d) for d in range(int(trees.depth.max()) + 1)] if n else []
    inward = local.copy()  # a node's potential times the messages of its children
    message = np.zeros((n, 2))  # to the parent, by the parent's label
    for nodes in reversed(levels[1:]):
        message[nodes] = log_sum(table[nodes] + inward[nodes][:, None, :])
        for label in (0, 1):
            np.add.at(inward[:, label], trees.parent[nodes], message[nodes, label])
    outward = np.zeros((n, 2))  # message from the parent, by the own label
    pair = np.zeros((n, 2, 2))
    for nodes in levels[1:]:
        up = trees.parent[nodes]
        rest = inward[up] + outward[up] - message[nodes]  # the parent without this child
        outward[nodes] = np.logaddexp(rest[:, None, 0] + table[nodes][:, 0, :], rest[:, None, 1] + table[nodes][:, 1, :])
        joint = rest[:, :, None] + table[nodes] + inward[nodes][:, None, :]
        joint -= joint.max(axis=(1, 2), keepdims=True)
        weight = np.exp(joint)
        pair[nodes] = weight / weight.sum(axis=(1, 2), keepdims=True)
    belief = inward + outward
    return 1.0 / (1.0 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), pair


def labelled(pages: Sequence[str]) -> tuple[list[Page], np.ndarray]:
    """Trees of the marked pages and the label of each node: most of its text is marked."""
    trees, labels = [], []
    for source in pages:
        page = read_page(source)
        n = len(page.parent)
        weight, marked = [len(t) for t in page.text], [len(t) if MARK in t else 0 for t in page.text]
        for i in range(n - 1, 0, -1):
            weight[page.parent[i]] += weight[i]
            marked[page.parent[i]] += marked[i]
        labels += [2 * m > w for w, m in zip(weight, marked, strict=True)]
        trees.append(page._replace(text=[t.replace(MARK, "") for t in page.text]))
    return trees, np.array(labels, bool)


def train(pages: Sequence[str], steps: int = STEPS, rate: float = 0.1, decay: float = 2e-4) -> Model:
    """Weights of highest likelihood over the labelled pages."""
    sources, labels = labelled(pages)
    trees = forest(sources)
    inner = trees.parent >= 0
    size = FEATURES + EDGES * 4
    seen = np.bincount(trees.feature, labels[trees.owner].astype(float), FEATURES)
    own, up = labels[inner].astype(int), labels[trees.parent[inner]].astype(int)
    seen_edges = np.bincount(trees.kind[inner] * 4 + up * 2 + own, minlength=EDGES * 4)
    target = np.concatenate([seen, seen_edges])
    weights, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        content, pair = marginals(trees, Model(weights[:FEATURES], weights[FEATURES:].reshape(EDGES, 2, 2)))
        expected = np.bincount(trees.feature, content[trees.owner], FEATURES)
        met = np.zeros((EDGES, 4))
        np.add.at(met, trees.kind[inner], pair[inner].reshape(-1, 4))
        gradient = (np.concatenate([expected, met.ravel()]) - target) / len(sources) + decay * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient * gradient
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    return Model(weights[:FEATURES], weights[FEATURES:].reshape(EDGES, 2, 2))


@functools.lru_cache(maxsize=1)
def trained() -> Model:
    return train(labelled_pages())


def texts_of(sources: Sequence[str | None], model: Model) -> list[str]:
    """The main text of each page."""
    pages = [read_page(s or "") for s in sources]
    trees = forest(pages)
    content, _ = marginals(trees, model)
    found, base = [], 0
    for page in pages:
        keep = content[base : base + len(page.parent)] >= 0.5
        found.append("\n".join(t for t, k in zip(page.text, keep.tolist(), strict=True) if t and k))
        base += len(page.parent)
    return found


def extract(pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), source: str = "html", model: Model | None = None) -> DataFrame:
    """The `keep` columns of every page with its main `text` and `n_chars`; the model is a few hundred numbers."""
    keep = list(keep)
    shared = pages.sparkSession.sparkContext.broadcast(tuple(model or trained()))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Model(*shared.value)
        for part in slices(batches, "__html", 1 << 20):
            texts = texts_of(part.column("__html").to_pylist(), weights)
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(texts, pa.string()), sizes], [*keep, "text", "n_chars"])

    return pages.select(*keep, pages[source].alias("__html")).mapInArrow(run, f"{columns}, text string, n_chars long")
