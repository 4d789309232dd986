"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics (``statistics.FEATURES``) come from the whole text. Trees are fitted on the
driver on a bounded sample of labelled rows (TRAIN_ROWS, chosen by hash) with the values of each statistic
in BINS quantile bins, and flattened to arrays of split statistic, split value and leaf value, which a
vectorised numpy traversal walks for a slice of texts at a time.

Defined cases: a null text is an empty one and gets a score too; without labels of both kinds every text
gets the share of label 1 with one pseudo-count each; repeated rows are scored alike; rows with
a null id are scored and count as not held out; an empty table gives no rows; extra columns are
kept, and one named like an added column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.batches import field, map_batches
from tidemark.llm.bytescan import slices
from tidemark.llm.labelled import FOLDS, HELD_OUT, labelled_sample
from tidemark.llm.statistics import FEATURES, Scan, features

TRAIN_ROWS = 12_000
BINS, DEPTH, TREES, RATE, RIDGE, LEAST = 32, 4, 60, 0.2, 1.0, 8


@dataclass
class Forest:
    """Complete binary trees in arrays: inner node i has the children 2i+1 and 2i+2."""

    prior: float
    feature: np.ndarray  # [trees, 2^depth - 1]
    cut: np.ndarray  # [trees, 2^depth - 1]; a value above it goes right
    leaf: np.ndarray  # [trees, 2^depth]

    def raw(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.prior), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boosting with second-order gains of the logistic loss on binned values."""
    good = float(y.sum())
    prior = float(np.log((good + 1) / (len(y) - good + 1)))
    inner = (1 << depth) - 1
    if not len(y) or good in (0, len(y)):
        trees = 0
    shape = (trees, inner)
    forest = Forest(prior, np.zeros(shape, np.int64), np.full(shape, np.inf), np.zeros((trees, inner + 1)))
    if not trees:
        return forest
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    width = x.shape[1]
    # One histogram serves all statistics of all nodes of a level.
    slot = binned + np.arange(width) * BINS
    score = np.full(len(y), prior)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            where = ((node - first)[:, None] * (width * BINS) + slot).ravel()
            sums = [
                np.bincount(where, np.repeat(w, width), many * width * BINS).reshape(many, width, BINS)
                for w in (slope, bend, np.ones(len(y)))
            ]
            (gl, hl, nl), (g, h, n) = (np.cumsum(s, 2) for s in sums), (s.sum(2, keepdims=True) for s in sums)
            gain = gl**2 / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g**2 / (h + RIDGE)
            gain[(nl < LEAST) | (n - nl < LEAST)] = -np.inf
            best = gain.reshape(many, -1).argmax(1)
            for k, b in enumerate(best):
                f, cut = divmod(int(b), BINS)
                if gain[k, f, cut] > 1e-9:
                    forest.feature[t, first + k], forest.cut[t, first + k] = f, edges[f][min(cut, len(edges[f]) - 1)]
            node = 2 * node + 1 + (x[np.arange(len(y)), forest.feature[t, node]] > forest.cut[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        forest.leaf[t] = RATE * g / (h + RIDGE)
        score += forest.leaf[t][leaf]
    return forest


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Forest:
    """Fit on at most `rows` labelled documents outside the held-out fold."""
    folds = tuple(k for k in range(FOLDS) if k != HELD_OUT)

    def work(batches):
        for b in batches:
            for texts in slices(field(b, "text")):
                x = features(Scan(texts)).astype(np.float64)
                y = np.array(field(b, "label").slice(texts.first, len(texts)), np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([np.column_stack([x, y]).tobytes()], pa.binary())], ["rows"])

    found = map_batches(labelled_sample(documents, labels, folds, rows), "rows binary", work).collect()
    table = np.concatenate([np.empty((0, len(FEATURES) + 1)), *[np.frombuffer(r[0]).reshape(-1, len(FEATURES) + 1) for r in found]])
    table = table[np.lexsort(table.T)]  # the order of rows must not matter
    return fit(table[:, :-1], table[:, -1])


def score(documents: DataFrame, forest: Forest, at_least: float | None = None, name: str | None = "score") -> DataFrame:
    """Add the probability of label 1 as column `name`, or drop rows below `at_least`, or both."""
    kept = [f for f in documents.schema if f.name != name]
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ([f"`{name}` double"] if name else [])

    def work(batches):
        for b in batches:
            found = [forest.probability(features(Scan(texts))) for texts in slices(field(b, "text"))]
            p = np.concatenate(found) if found else np.empty(0)
            columns = [field(b, f.name) for f in kept] + ([pa.array(p)] if name else [])
            out = pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + ([name] if name else []))
            yield out if at_least is None else out.filter(pa.array(p >= at_least))

    return map_batches(documents, ", ".join(schema), work)
