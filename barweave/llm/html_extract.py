"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

Every node of a page's DOM, elements and runs of text alike, gets a margin from boosted trees over
its features. Nodes are kept or dropped together so that no node is kept under a dropped one: of all
such choices the one with the largest sum of margins is taken, by one pass from the leaves up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.batches import chunks
from barweave.llm.html_dom import TEXT, Node, features, parse
from barweave.llm.html_samples import KEPT, Maker

#: Pages whose texts the training pages are made of, and training pages made: the fit's bounds.
SAMPLE_PAGES = 64
TRAINING_PAGES = 300
TREES, TREE_DEPTH = 14, 5


class Trees(NamedTuple):
    """All trees' nodes in one array each; a leaf leads to itself."""

    feature: np.ndarray
    limit: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray


def labels(nodes: list[Node], parent: np.ndarray) -> np.ndarray:
    """Whether each node of a made page holds text of the article."""
    out = np.array([KEPT in node.text for node in nodes])
    for at in range(len(nodes) - 1, 0, -1):
        out[parent[at]] |= out[at]
    return out


def fit(pages: DataFrame) -> Trees:
    """Trees fitted on pages made around the texts of a bounded sample of ``pages``."""
    sample = pages.where("html IS NOT NULL").orderBy(F.xxhash64("page_id"), "html")
    texts = []
    for row in sample.select("html").limit(SAMPLE_PAGES).collect():
        nodes, _, _ = features(parse(row["html"]))
        texts += [node.text for node in nodes if node.tag == TEXT]
    maker = Maker(texts, seed=7)
    rows = []
    for _ in range(TRAINING_PAGES):
        page = maker.page()
        nodes, values, parent = features(parse(page))
        for value, label in zip(values, labels(nodes, parent), strict=True):
            rows.append((Vectors.dense(value), float(label)))
    frame = pages.sparkSession.createDataFrame(rows, ["features", "label"]).coalesce(1)
    learner = GBTClassifier(
        maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.3, seed=7, maxBins=32, cacheNodeIds=False
    )
    model = learner.fit(frame)
    return read_trees(model.toDebugString, model.treeWeights)


_STEP = re.compile(r"(If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)|Predict: ([-+.\dEe]+)")


def read_trees(shown: str, weights: list[float]) -> Trees:
    """The trees from the model's own listing, which has each node once, first branches first."""
    feature, limit, low, high, value, roots = [], [], [], [], [], []
    open_: list[int] = []  # branches whose next child is to come

    def add(*node) -> int:
        at = len(feature)
        for column, item in zip((feature, limit, low, high, value), node, strict=True):
            column.append(item)
        if open_:
            above = open_.pop()
            (low if low[above] == -1 else high)[above] = at
        else:
            roots.append(at)
        return at

    for kind, name, _, bound, leaf in _STEP.findall(shown):
        if leaf:
            at = add(0, np.inf, -2, -2, float(leaf))
            low[at] = high[at] = at
        elif kind == "If":
            at = add(int(name), float(bound), -1, -1, 0.0)
            open_ += [at, at]
    arrays = (feature, limit, low, high, value, roots, weights)
    kinds = (np.int64, float, np.int64, np.int64, float, np.int64, float)
    return Trees(*(np.array(a, k) for a, k in zip(arrays, kinds, strict=True)))


def margins(trees: Trees, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows))
    each = np.arange(len(rows))
    for root, weight in zip(trees.roots, trees.weights, strict=True):
        at = np.full(len(rows), root)
        for _ in range(TREE_DEPTH):
            goes_low = rows[each, trees.feature[at]] <= trees.limit[at]
            at = np.where(goes_low, trees.low[at], trees.high[at])
        out += weight * trees.value[at]
    return out


def decode(margin: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The nodes to keep: the best sum of margins (kept plus, dropped minus) in which whatever is
    under a dropped node is dropped."""
    n = len(margin)
    dropped, kept = -margin.copy(), margin.copy()
    for at in range(n - 1, 0, -1):
        up = parent[at]
        dropped[up] += dropped[at]
        kept[up] += max(kept[at], dropped[at])
    stays = np.zeros(n, bool)
    for at in range(n):
        over = parent[at]
        stays[at] = kept[at] > dropped[at] and (over < 0 or stays[over])
    return stays


def extract(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of each whole page.

    One row per input row, repeated rows included. A null or empty page, one without an article or
    one that is no HTML at all but blanks has an empty text; plain text without markup is its text
    if the trees take it for one. Other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(trees or fit(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "html"):
                made = [features(parse(page)) for page in part.column(2).to_pylist()]
                every = margins(shared.value, np.concatenate([rows for _, rows, _ in made]))
                texts, at = [], 0
                for nodes, rows, parent in made:
                    stays = decode(every[at : at + len(rows)], parent)
                    at += len(rows)
                    found = [n.text for n, s in zip(nodes, stays, strict=True) if s and n.tag == TEXT]
                    texts.append("\n\n".join(found))
                sizes = pa.array([len(text) for text in texts], pa.int64())
                arrays = [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes]
                yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    frame = pages.select("page_id", "url", "html")
    kind = pages.schema["page_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
