"""Main text of web pages: boosted trees over DOM nodes, decoded down the tree (operator 11).

1. ``dom.parse`` makes nodes and runs of text of a page, ``dom.features`` describes each
   node by its kind, the words in its names and in those above it, its subtree's text, links
   and density, its depth and place, and its siblings.
2. Gradient-boosted trees (``boosting``), fitted here on pages of a grammar whose parts are
   known (``page_grammar``), give each node's log-odds of belonging to the main text.
3. ``decoded`` takes the set of nodes of the greatest total log-odds among those that hold
   no node without its parent: nothing inside a rejected part is kept, and a good paragraph
   can only be kept with all that it stands in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.llm import boosting, dom, page_grammar
from playlake.llm.common import ship
from playlake.llm.words import chunks

#: Pages of the training set and their seed: the bound of the labelled sample.
PAGES, SEED = 500, 1
#: A node's log-odds count at most this much, so that many paragraphs do not outvote what they stand in.
MOST = 6.0
DROP = -1e9


def marked(page: dom.Page) -> tuple[np.ndarray, np.ndarray]:
    """(label, use) of each node of a page of the grammar: 1 if main text stands in it."""
    n = len(page.parent)
    out = np.zeros(n, bool)  # inside a marked part
    for i in range(1, n):
        out[i] = out[page.parent[i]] or page.gold[i] == 0
    label, some = np.zeros(n, bool), np.zeros(n, bool)
    for run in page.runs:
        for node, text, _ in run:
            if text.strip():
                some[node] = True
                label[node] |= not out[node]
    for i in range(n - 1, 0, -1):
        label[page.parent[i]] |= label[i]
        some[page.parent[i]] |= some[i]
    return label, some & ~np.array(page.drop)


@lru_cache(4)
def fit(pages: int = PAGES, seed: int = SEED) -> boosting.Trees:
    """The classifier, fitted on ``pages`` labelled pages of the grammar."""
    x, y = [], []
    for html in page_grammar.pages(pages, seed):
        page = dom.parse(html)
        label, use = marked(page)
        x.append(dom.features(page)[use])
        y.append(label[use])
    return boosting.fit(np.concatenate(x), np.concatenate(y).astype(np.float64))


def decoded(page: dom.Page, logit: np.ndarray) -> np.ndarray:
    """Nodes of the main text: the set of greatest total log-odds that holds each node's parent."""
    n = len(page.parent)
    gain = np.clip(logit, -MOST, MOST)
    gain[np.array(page.drop)] = DROP
    gain[0] = max(gain[0], 0.0)  # the page itself is no choice
    gain = gain.tolist()
    # what stands in a node can cost it nothing, and can outvote it by its own certainty only
    best = gain[:]
    lift = [0.0] * n
    for i in range(n - 1, 0, -1):
        best[i] = gain[i] + min(lift[i], MOST)
        if best[i] > 0:
            lift[page.parent[i]] += best[i]
    chosen = np.zeros(n, bool)
    chosen[0] = True
    for i in range(1, n):
        chosen[i] = chosen[page.parent[i]] and best[i] > 0
    return chosen


def main_texts(html: list[str], model: boosting.Trees) -> list[str]:
    pages = [dom.parse(h) for h in html]
    sizes = np.cumsum([0, *(len(p.parent) for p in pages)])
    logit = model.logit(np.concatenate([dom.features(p) for p in pages])) if pages else np.zeros(0)
    return [dom.blocks(p, decoded(p, logit[i:j])) for p, i, j in zip(pages, sizes[:-1], sizes[1:])]


def extract_batches(model: boosting.Trees) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(batch.num_columns - 1)
            for i, j in chunks(html, 1 << 19):
                part = batch.slice(i, j - i)
                text = main_texts(part.column(part.num_columns - 1).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(text, pa.string())], names=batch.schema.names)

    return run


def extract(pages: DataFrame, model: boosting.Trees, keep: list[str], html: str = "html") -> DataFrame:
    """The columns ``keep`` and ``text``, the main text of each page.

    Blocks are lines; white space within one is one space, character references are decoded.
    A null or empty page has an empty text, and so has a page without main text.  Rows stand
    alone: repeated rows give equal texts, an empty table none.  Columns not in ``keep`` are
    left out; ``keep`` may not hold ``text``.
    """
    if "text" in keep:
        raise ValueError("a column to keep has the name of the result")
    ship(pages.sparkSession)
    body: Column = F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("text")
    src = pages.select(*[F.col(f"`{c}`") for c in keep], body)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)
    return src.mapInArrow(extract_batches(model), kinds)
