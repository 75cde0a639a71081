"""Main text of web pages by a tree-structured graphical model over the page's elements.

Each element is content, foreign to it, or a frame: no content itself, but around some. An element's own features (tag, names in its attributes, length and links of its text,
its place in the page) score its label; potentials between parent and child score their pair of labels, by kind of child.
Sum-product messages, once upward and once downward, give every element's exact marginal. Weights maximise the
likelihood of labelled pages, whose gradient needs the same marginals. Messages of many pages are passed together, level
by level of their trees.

Labelled pages are HTML texts where ``data-main="1"`` marks content and ``data-main="0"`` what is none, for an element and
all below it that is not marked otherwise; outside marks nothing is content.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.html_tree import INLINE, Page, blocks
from corpusmill.llm.labelled_pages import labelled_pages

#: Labelled pages a model is fitted on at most; the rest is not read.
TRAIN_PAGES = 2_000
STEPS, RATE, DECAY = 120, 0.4, 0.0005
#: Elements whose messages are passed together, about.
NODES = 20_000
#: Attribute texts whose features a task remembers; a full memory starts afresh.
MEMO_ATTRS = 50_000

_NAMED = re.compile(r"(?<![\w-])(class|id|role|itemprop|itemtype|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_MARK = re.compile(r"(?<![\w-])data-main\s*=\s*[\"']?([01])")

LEAF_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption caption summary".split())
PARTS = frozenset("nav aside footer header form article main section".split())
KINDS = 4
FOREIGN, CONTENT, FRAME = range(3)
LABELS = 3


def kind(tag: str) -> int:
    """Kinds of child that potentials tell apart: inline, of text, parts of a page, other containers."""
    return 0 if tag in INLINE else 1 if tag in LEAF_TAGS else 2 if tag in PARTS else 3


def names(tag: str, attrs: str, above: str) -> list[str]:
    """Features of an element's tag, its parent's, and the words, and pieces of words, in its naming attributes."""
    found = [f"tag:{tag}", f"below:{above}>{tag}"]
    for _, value in _NAMED.findall(attrs):
        for word in _WORD.findall(value):
            word = word.lower()
            if len(word) > 1:
                found.append(f"word:{word}")
                found += [f"piece:{word[i:i + 4]}" for i in range(len(word) - 3)]
    return list(dict.fromkeys(found))


def elements_of(page: Page) -> Iterator[tuple[str, str, str]]:
    """Each element's tag, attributes, and its parent's tag."""
    return ((tag, attrs, page.tags[above] if above >= 0 else "") for tag, attrs, above in zip(page.tags, page.attrs, page.parents))


@dataclass
class Forest:
    """The elements of several pages: parents first, roots have parent -1; levels hold the elements of one depth.

    In document order the children of one element follow each other within their level: ``firsts`` are the places where
    the next element's children start.
    """

    parents: np.ndarray
    kinds: np.ndarray
    levels: list[np.ndarray]
    firsts: list[np.ndarray]

    def upward(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """From the deepest level on: the elements, where siblings start, and their parents."""
        for level, first in zip(reversed(self.levels[1:]), reversed(self.firsts[1:])):
            yield level, first, self.parents[level[first]]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per element the sum over itself and all below."""
        out = values.astype(np.float64)
        for level, first, above in self.upward():
            out[above] += np.add.reduceat(out[level], first)
        return out


def forest(parents: np.ndarray, kinds: np.ndarray) -> Forest:
    depths = np.zeros(len(parents), np.int64)
    for node, parent in enumerate(parents.tolist()):
        if parent >= 0:
            depths[node] = depths[parent] + 1
    order = np.argsort(depths, kind="stable")
    edges = np.flatnonzero(np.diff(depths[order])) + 1
    levels = np.split(order, edges) if len(order) else []
    firsts = [np.concatenate(([0], np.flatnonzero(np.diff(parents[level])) + 1)) for level in levels]
    return Forest(parents, kinds, levels, firsts)


def marginals(trees: Forest, unary: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each element's labels, and of each (parent, child) pair of labels, by sum-product.

    ``unary``: a log potential per element and label; ``pairs``: potentials by kind of child, parent's and child's label.
    The second result is per element, with its parent; it is zero for roots.
    """
    n, labels = unary.shape
    up, sent, own = unary.astype(np.float64), np.zeros((n, labels)), np.zeros((n, labels))
    for level, first, above in trees.upward():
        own[level] = np.exp(up[level] - up[level].max(axis=1, keepdims=True))
        sent[level] = np.log(np.einsum("npc,nc->np", pairs[trees.kinds[level]], own[level]))
        up[above] += np.add.reduceat(sent[level], first)
    both, found = np.zeros((n, labels, labels)), np.zeros((n, labels))
    for level in trees.levels[:1]:
        found[level] = _normed(np.exp(up[level] - up[level].max(axis=1, keepdims=True)))
    for level in trees.levels[1:]:
        # what the parent knows without this child
        rest = np.log(np.maximum(found[trees.parents[level]], 1e-300)) - sent[level]
        rest = np.exp(rest - rest.max(axis=1, keepdims=True))
        joint = rest[:, :, None] * pairs[trees.kinds[level]] * own[level][:, None, :]
        both[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
        found[level] = both[level].sum(axis=1)
    return found, both


def _normed(values: np.ndarray) -> np.ndarray:
    return values / values.sum(axis=-1, keepdims=True)


def _buckets(values: np.ndarray, edges: list[float]) -> tuple[np.ndarray, int]:
    return np.searchsorted(edges, values, side="right"), len(edges) + 1


class Batch:
    """Several parsed pages and the measured features of their elements."""

    def __init__(self, pages: list[Page]):
        self.pages, self.starts = pages, np.cumsum([0] + [len(p.tags) for p in pages])
        total = int(self.starts[-1])
        parents, own = np.empty(total, np.int64), np.zeros(total)
        inside, rooted = np.zeros(total, bool), np.zeros(total, bool)
        kinds = np.array([kind(tag) for p in pages for tag in p.tags], np.int64)
        links = np.array([tag == "a" for p in pages for tag in p.tags])
        for start, page in zip(self.starts.tolist(), pages):
            end = start + len(page.tags)
            parents[start:end] = page.parents
            parents[start + 1 : end] += start
            for node, _, text in page.texts:
                own[start + node] += 0 if text.isspace() else len(text)
            # an only article or main part names the content's root
            rooted[start:end] = page.tags.count("article") == 1 or page.tags.count("main") == 1
            for node, tag in enumerate(page.tags):
                above = page.parents[node]
                inside[start + node] = tag in ("article", "main") or (above >= 0 and inside[start + above])
        self.trees = forest(parents, kinds)
        # inside a link: the link or below one
        in_link = links.copy()
        for level in self.trees.levels[1:]:
            in_link[level] |= in_link[parents[level]]
        whole, linked = self.trees.sums(own), self.trees.sums(own * in_link)
        page_of = np.repeat(np.arange(len(pages)), np.diff(self.starts))
        all_text = np.maximum(1, whole[self.starts[:-1]] if len(pages) else np.zeros(0))[page_of]
        link_share = np.where(whole > 0, linked / np.maximum(1, whole), -1)
        # one of many paragraphs has a small share wherever it stands
        share = np.where(kinds >= 2, whole / all_text, -1)
        links_bucket, n_links = _buckets(link_share, [0, 0.01, 0.1, 0.3, 0.6, 0.9])
        share_bucket, n_share = _buckets(share, [0, 0.001, 0.02, 0.1, 0.3, 0.6, 0.9])
        measured = {
            "own": _buckets(own, [1, 10, 25, 60, 120]),
            "links": (links_bucket, n_links),
            "share": (share_bucket * n_links + links_bucket, n_share * n_links),
            "root": (inside + 2 * rooted, 4),
        }
        # everything is told apart by kind
        self.measured = {name: (bucket * KINDS + kinds, n * KINDS) for name, (bucket, n) in measured.items()}


class Model:
    """Weights of features by label, against the first one, and the potentials between labels."""

    def __init__(self, vocabulary: dict[str, int], measured: dict[str, int], weights: np.ndarray, pairs: np.ndarray):
        self.vocabulary, self.measured, self.weights, self.pairs = vocabulary, measured, weights, pairs
        self._memo: dict[tuple[str, str, str], list[int]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_memo": {}}

    def named(self, tag: str, attrs: str, above: str) -> list[int]:
        key = (tag, attrs if "=" in attrs else "", above)
        found = self._memo.get(key)
        if found is None:
            if len(self._memo) >= MEMO_ATTRS:
                self._memo.clear()
            found = [self.vocabulary[n] for n in names(*key) if n in self.vocabulary]
            self._memo[key] = found
        return found

    def active(self, batch: Batch) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of element and feature."""
        lists = [self.named(*element) for p in batch.pages for element in elements_of(p)]
        elements = [np.repeat(np.arange(len(lists)), [len(x) for x in lists])]
        features = [np.fromiter((f for x in lists for f in x), np.int64)]
        for name, (bucket, _) in batch.measured.items():
            elements.append(np.arange(len(bucket)))
            features.append(self.measured[name] + bucket)
        return np.concatenate(elements), np.concatenate(features)

    def scores(self, elements: np.ndarray, features: np.ndarray, total: int) -> np.ndarray:
        columns = [np.bincount(elements, weights=w[features], minlength=total) for w in self.weights]
        return np.stack([np.zeros(total), *columns], axis=1)

    def unary(self, batch: Batch) -> np.ndarray:
        return self.scores(*self.active(batch), int(batch.starts[-1]))

    def probabilities(self, pages: list[Page]) -> list[np.ndarray]:
        """Per page the marginal of each element being content."""
        batch = Batch(pages)
        found, _ = marginals(batch.trees, self.unary(batch), self.pairs)
        return np.split(found[:, CONTENT], batch.starts[1:-1])


def labels(page: Page) -> np.ndarray:
    """By the nearest mark; an element that is no content but holds some is a frame."""
    out = np.full(len(page.tags), FOREIGN, np.int64)
    for node, (attrs, parent) in enumerate(zip(page.attrs, page.parents)):
        mark = _MARK.search(attrs)
        if mark:
            out[node] = CONTENT if mark[1] == "1" else FOREIGN
        elif parent >= 0 and out[parent] == CONTENT:
            out[node] = CONTENT
    for node in range(len(out) - 1, 0, -1):
        if out[node] != FOREIGN and out[page.parents[node]] == FOREIGN:
            out[page.parents[node]] = FRAME
    return out


def potentials(odds: np.ndarray) -> np.ndarray:
    """Potentials from the log odds of a child's label by kind and parent's label.

    They are normalised over the child's label, so that a child without evidence of its own says nothing to its parent,
    however many such children there are.
    """
    return _normed(np.exp(odds - odds.max(axis=-1, keepdims=True)))


def _by_kind(kinds: np.ndarray, values: np.ndarray) -> np.ndarray:
    flat = values.reshape(len(values), LABELS * LABELS).T
    return np.stack([np.bincount(kinds, weights=v, minlength=KINDS) for v in flat], axis=1).reshape(-1, LABELS, LABELS)


def train(labelled: Iterable[str] | None = None, pages: int = TRAIN_PAGES) -> Model:
    """The model of the labelled pages, at most ``pages`` of them; without any, of the library's own labelled layouts."""
    return _own_model() if labelled is None else _fitted([Page(text) for text in islice(labelled, pages)])


@cache
def _own_model() -> Model:
    return _fitted([Page(text) for text in labelled_pages()])


def _fitted(parsed: list[Page]) -> Model:
    batch, truth = Batch(parsed), np.concatenate([labels(p) for p in parsed])
    vocabulary: dict[str, int] = {}
    for page in parsed:
        for element in elements_of(page):
            for name in names(*element):
                vocabulary.setdefault(name, len(vocabulary))
    measured, size = {}, len(vocabulary)
    for name, (_, n) in batch.measured.items():
        measured[name], size = size, size + n
    odds = np.zeros((KINDS, LABELS, LABELS))
    model = Model(vocabulary, measured, np.zeros((LABELS - 1, size)), potentials(odds))
    elements, features = model.active(batch)
    below = np.flatnonzero(batch.trees.parents >= 0)
    kinds, above = batch.trees.kinds[below], truth[batch.trees.parents[below]]
    known = np.eye(LABELS)[truth]
    seen = _by_kind(kinds, np.eye(LABELS * LABELS)[LABELS * above + truth[below]])
    # Adam steps of falling size on the mean log likelihood
    values, means, squares = (model.weights, odds), [0, 0], [0, 0]
    for step in range(1, STEPS + 1):
        found, both = marginals(batch.trees, model.scores(elements, features, len(truth)), model.pairs)
        surplus, missed = seen - _by_kind(kinds, both[below]), (known - found)[elements]
        slopes = (
            np.stack([np.bincount(features, weights=missed[:, n], minlength=size) for n in range(1, LABELS)]),
            surplus - model.pairs * surplus.sum(axis=2, keepdims=True),
        )
        for n, slope in enumerate(slopes):
            slope = slope / len(parsed) - DECAY * values[n]
            means[n] = 0.9 * means[n] + 0.1 * slope
            squares[n] = 0.99 * squares[n] + 0.01 * slope * slope
            fall = RATE * (1 - step / (STEPS + 1)) / (1 - 0.9**step)
            values[n][...] += fall * means[n] / (np.sqrt(squares[n] / (1 - 0.99**step)) + 1e-8)
        model.pairs = potentials(odds)
    return model


def main_text(page: Page, content: np.ndarray) -> str:
    return blocks(page, (content > 0.5).tolist())


def _extractor(model: Model):
    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts, waiting, nodes = [], [], 0

            def answered():
                return [main_text(p, content) for p, content in zip(waiting, model.probabilities(waiting))]

            for value in batch:
                source = value.as_py() or ""
                waiting.append(Page(source))
                # long texts count as the elements they could hold
                nodes += len(waiting[-1].tags) + len(source) // 200
                if nodes >= NODES:
                    texts += answered()
                    waiting, nodes = [], 0
            if waiting:
                texts += answered()
            yield pa.array(texts, pa.string())

    return extract


def extract(pages: DataFrame, model: Model, html_col: str = "html") -> DataFrame:
    """``page, text``: each row as a struct, and its main text, blocks as lines.

    NULL and empty pages, and pages without content, have an empty text. Rows that repeat come back each; very long
    pages are read whole, one after the other. Other columns pass through the struct under their own names. An empty
    table gives no rows.
    """
    return pages.select(F.struct("*").alias("page"), _extractor(model)(F.col(html_col)).alias("text"))
