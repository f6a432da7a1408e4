"""Main text of web pages by a graphical model on their trees.

Each node of a page's tree has a hidden state: a shell around the main part, a
part of it, or something else.  A node's own looks (element, names, amounts of
text, links and marks) weigh for a state, and a potential on each parent-child
edge, by the child's element, ties neighbours together.  Messages are summed from
the leaves to the root and back, which gives each node's exact marginal; text
below nodes that are rather main than not is the page's text.  The weights maximise the likelihood of labelled pages, whose
gradient is what the same messages expect, against what is marked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, slices
from .dom import BLOCK, Page, parse
from .labelled_pages import labelled_pages

#: Labelled pages to learn from, passes over them, and the weight that holds weights small.
PAGES, PASSES, DECAY = 900, 150, 3e-5
SHELL, MAIN, OTHER = STATES = range(3)
_TAGS = {tag: i for i, tag in enumerate(sorted(BLOCK), 1)}
#: Elements whose text is never shown as text.
_UNSEEN = ("head", "template", "svg", "math", "select", "option", "button", "object", "canvas", "audio", "video")
#: A name counts as a whole, by how it starts and by how it ends.
_NAME_LOOKS = (("name", slice(None)), ("starts", slice(4)), ("ends", slice(-3, None)))


@dataclass
class Forest:
    """The nodes of some pages, each page's before the next's."""

    parent: np.ndarray
    kind: np.ndarray
    depths: list[np.ndarray]  # nodes by depth
    places: np.ndarray  # the features of all nodes, one after the other
    owner: np.ndarray  # the node of each


@dataclass
class Model:
    features: dict[str, int]
    weights: np.ndarray  # by feature and state
    #: Potentials by the child's element, the parent's state and the child's.
    edges: np.ndarray


def _share(part: float, whole: float, limits: tuple[float, ...]) -> int:
    return sum(part > limit * whole for limit in limits)


def _looks(page: Page) -> list[list[str]]:
    """What the model sees of each node."""
    n = len(page.tag)
    own = np.zeros((n, 4))  # words, words in links, ends of sentences, characters before
    before = np.full(n, -1.0)
    total = 0
    for node, _, text, linked in page.pieces:
        words = text.count(" ") + 1 if text.strip() else 0
        own[node] += (words, words * linked, sum(text.count(c) for c in ".!?:"), 0)
        if before[node] < 0:
            before[node] = total
        total += words
    all_ = own.copy()
    children = [0] * n
    for i in range(n - 1, 0, -1):
        all_[page.parent[i]] += all_[i]
        children[page.parent[i]] += 1
    out, depth = [], [0] * n
    for i in range(n):
        up = page.parent[i]
        depth[i] = depth[up] + 1 if i else 0
        words, links, ends, _ = all_[i]
        looks = [
            f"tag {page.tag[i]}",
            f"words {_share(words, 1, (0, 2, 5, 15, 50, 200))}",
            f"own {_share(own[i, 0], 1, (0, 2, 5, 15, 50))}",
            f"share {_share(words, total, (0, 0.02, 0.1, 0.3, 0.6, 0.9))}",
            f"links {_share(links, words, (0, 0.2, 0.5, 0.9)) if words else 'none'}",
            f"ends {_share(ends, words, (0, 0.02, 0.1, 0.3)) if words else 'none'}",
            f"children {_share(children[i], 1, (0, 1, 3, 10))}",
        ]
        if i:
            looks.append(f"below {page.tag[up]}")
        if depth[i] > 1 and page.names[i]:
            looks += [f"{part} {name[cut]}" for name in page.names[i] for part, cut in _NAME_LOOKS]
            looks.append("named")
        out.append(looks)
    return out


def _forest(pages: list[Page], features: dict[str, int]) -> Forest:
    parent, kind, depth, places, owner = [], [], [], [], []
    for page in pages:
        begin = len(parent)
        for i, looks in enumerate(_looks(page)):
            up = page.parent[i]
            parent.append(begin + up if i else -1)
            depth.append(depth[begin + up] + 1 if i else 0)
            kind.append(_TAGS.get(page.tag[i], 0))
            known = [features[x] for x in looks if x in features]
            places += known
            owner += [begin + i] * len(known)
    depth = np.array(depth, np.int64)
    order = np.argsort(depth, kind="stable")
    by_depth = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []
    return Forest(np.array(parent, np.int64), np.array(kind), by_depth, np.array(places, np.int64), np.array(owner, np.int64))


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)


def marginals(forest: Forest, unary: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node's probabilities of its states, and each node's joint table with its parent (parent's state first).

    ``unary`` is what speaks for each state; roots have no parent, their table is nothing.
    """
    inside, outside = unary.copy(), np.zeros_like(unary)
    message, joint = np.zeros_like(unary), np.zeros((len(unary), len(STATES), len(STATES)))
    tables = edges[forest.kind]
    for nodes in reversed(forest.depths[1:]):
        message[nodes] = _log_sum(tables[nodes] + inside[nodes, None, :], 2)
        np.add.at(inside, forest.parent[nodes], message[nodes])
    for nodes in forest.depths[1:]:
        up = forest.parent[nodes]
        rest = inside[up] + outside[up] - message[nodes]
        table = tables[nodes] + rest[:, :, None]
        outside[nodes] = _log_sum(table, 1)
        table = table + inside[nodes, None, :]
        table = np.exp(table - table.max((1, 2), keepdims=True))
        joint[nodes] = table / table.sum((1, 2), keepdims=True)
    belief = inside + outside
    belief = np.exp(belief - belief.max(1, keepdims=True))
    return belief / belief.sum(1, keepdims=True), joint


def _unary(forest: Forest, weights: np.ndarray) -> np.ndarray:
    n = len(forest.parent)
    return np.stack([np.bincount(forest.owner, column[forest.places], n) for column in weights.T], 1)


def _states(page: Page) -> np.ndarray:
    """What a labelled page's marks say: unmarked nodes above a marked one are the shell."""
    state = np.where(page.marked, MAIN, OTHER)
    for i in range(len(state) - 1, 0, -1):
        if state[i] != OTHER and state[page.parent[i]] == OTHER:
            state[page.parent[i]] = SHELL
    return state


def fit(pages: list[str], passes: int = PASSES) -> Model:
    """A model of labelled pages, held in memory: their number is the caller's bound."""
    parsed = [parse(html) for html in pages]
    known: dict[str, int] = {}
    for page in parsed:
        for looks in _looks(page):
            for look in looks:
                known.setdefault(look, len(known))
    forest = _forest(parsed, known)
    state = np.concatenate([_states(page) for page in parsed])
    truth = np.eye(len(STATES))[state]
    below = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((len(_TAGS) + 1, len(STATES), len(STATES)))
    np.add.at(seen, (forest.kind[below], state[forest.parent[below]], state[below]), 1)
    values = [np.zeros((len(known), len(STATES))), np.zeros_like(seen)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for t in range(1, passes + 1):
        chance, joint = marginals(forest, _unary(forest, values[0]), values[1])
        missing = (truth - chance)[forest.owner]
        expected = np.zeros_like(seen)
        np.add.at(expected, forest.kind, joint)
        columns = [np.bincount(forest.places, column, len(known)) for column in missing.T]
        for i, (value, slope) in enumerate(zip(values, [np.stack(columns, 1), seen - expected])):
            slope = slope / len(state) - DECAY * value
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope**2
            value += 0.15 * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.99**t)) + 1e-8)
    return Model(known, values[0], values[1])


@lru_cache(1)
def default_model() -> Model:
    return fit(labelled_pages(PAGES))


def main_texts(pages: list[str], model: Model) -> list[str]:
    """The text of each page's main parts, blocks joined by one space."""
    parsed = [parse(html) for html in pages]
    forest = _forest(parsed, model.features)
    chance, _ = marginals(forest, _unary(forest, model.weights), model.edges)
    out, begin = [], 0
    for page in parsed:
        kept, last = [], None
        unseen = [False] * len(page.tag)
        for i, tag in enumerate(page.tag):
            unseen[i] = tag in _UNSEEN or (i > 0 and unseen[page.parent[i]])
        for node, block, text, _ in page.pieces:
            if chance[begin + node, MAIN] >= 0.5 and not unseen[node]:
                kept.append(text if block == last else " " + text)
                last = block
        out.append(" ".join("".join(kept).split()))
        begin += len(page.tag)
    return out


_COLUMNS = {"page_id": pa.int64(), "url": pa.string(), "text": pa.string(), "n_chars": pa.int64()}


def _extracted(model: Model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = main_texts([html or "" for html in part.column("html").to_pylist()], model)
                columns = [part.column("page_id"), part.column("url"), texts, [len(t) for t in texts]]
                yield pa.record_batch([pa.array(c, t) if isinstance(c, list) else c.cast(t) for c, t in zip(columns, _COLUMNS.values())], list(_COLUMNS))

    return rows


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages (page_id, url, html)``.

    Character references are decoded, white space of any kind inside a block is
    one space, blocks follow each other in page order after one space.  A null or
    empty page, and one without a main part, has an empty text.  Ids and
    addresses may be null or repeat; no rows give no rows; other columns are not
    read.  Without a model, one is fitted to ``PAGES`` generated labelled pages;
    fit one to pages marked by hand for pages of your own kind.  A page is handled
    as a whole, by one task; memory holds about 1 MB of pages, or one longer page.
    """
    return map_arrow(pages.select("page_id", "url", "html"), _extracted(model or default_model()), "page_id long, url string, text string, n_chars long")
