"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a lookup table over its quantile bins, and a few pairs of features have a table over coarser bins.
The tables are learned by cyclic boosting: round after round each feature in turn gets one shallow tree, fitted to the
gradient of the logistic loss and added to the feature's table. A score is the sum of one table entry per feature and
pair, squashed to 0..1, so scoring a batch is a handful of vectorised look-ups.

Learning uses at most ``sample_limit`` labelled rows, chosen by a hash of the id; scoring covers every row and whole
texts. Null and empty texts are scored like any text of no words. Without labelled rows, or with labels of one class
only, every score is the share of label 1 (1 without any label).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import label_sample, raw, table
from sluicebox.llm.stats import FEATURES, labelled_features, matrix, text_stats

SAMPLE_LIMIT = 20_000
THRESHOLD = 0.3
BINS, PAIR_BINS = 48, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 40, 6
RATE, LEAVES, LEAST = 0.15, 3, 20


@dataclass
class AdditiveModel:
    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        for k, cut in enumerate(self.cuts):
            total += self.tables[k][np.searchsorted(cut, rows[:, k], side="right")]
        for (a, b), values in zip(self.pairs, self.pair_tables, strict=True):
            left = np.searchsorted(self.pair_cuts[a], rows[:, a], side="right")
            total += values[left, np.searchsorted(self.pair_cuts[b], rows[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _shallow_tree(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Leaf value per bin of a tree of at most ``LEAVES`` leaves over one ordered feature."""
    leaves = [(0, len(gradient))]
    while len(leaves) < LEAVES:
        best = None
        for low, high in leaves:
            g, h, n = gradient[low:high].cumsum(), weight[low:high].cumsum(), count[low:high].cumsum()
            if high - low < 2:
                continue
            gain = g[:-1] ** 2 / (h[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1) - g[-1] ** 2 / (h[-1] + 1)
            gain[(n[:-1] < LEAST) | (n[-1] - n[:-1] < LEAST)] = -1
            k = int(gain.argmax())
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = gain[k], low, high, low + k + 1
        if best is None:
            break
        _, low, high, middle = best
        leaves.remove((low, high))
        leaves += [(low, middle), (middle, high)]
    values = np.zeros(len(gradient))
    for low, high in leaves:
        values[low:high] = gradient[low:high].sum() / (weight[low:high].sum() + 1)
    return values


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that splits each of two features once."""
    g, h = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    best, values = 0.0, np.zeros_like(gradient)
    for i in range(gradient.shape[0] - 1):
        for j in range(gradient.shape[1] - 1):
            parts = []
            for top in (g, h):
                a, b, c, d = top[i, j], top[i, -1] - top[i, j], top[-1, j] - top[i, j], top[-1, -1] - top[i, -1] - top[-1, j] + top[i, j]
                parts.append(np.array([[a, b], [c, d]]))
            gain = float((parts[0] ** 2 / (parts[1] + 1)).sum() - g[-1, -1] ** 2 / (h[-1, -1] + 1))
            if gain > best:
                leaf = parts[0] / (parts[1] + 1)
                best = gain
                values = np.repeat(np.repeat(leaf, [i + 1, gradient.shape[0] - i - 1], 0), [j + 1, gradient.shape[1] - j - 1], 1)
    return best, values


def fit(rows: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Cyclic boosting over the features, then over the pairs that promise most."""
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 1.0
        return AdditiveModel(float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -30, 30)))
    share = labels.mean()
    model = AdditiveModel(float(np.log(share / (1 - share))))
    model.cuts = [_cuts(column, BINS) for column in rows.T]
    model.tables = [np.zeros(len(cut) + 1) for cut in model.cuts]
    bins = [np.searchsorted(cut, column, side="right") for cut, column in zip(model.cuts, rows.T, strict=True)]
    total = np.full(len(labels), model.base)
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables, strict=True)]
    for _ in range(ROUNDS):
        for k, values in enumerate(model.tables):
            chance = 1 / (1 + np.exp(-total))
            gradient = np.bincount(bins[k], labels - chance, len(values))
            step = RATE * _shallow_tree(gradient, np.bincount(bins[k], chance * (1 - chance), len(values)), counts[k])
            values += step
            total += step[bins[k]]
    model.pair_cuts = [_cuts(column, PAIR_BINS) for column in rows.T]
    coarse = [np.searchsorted(cut, column, side="right") for cut, column in zip(model.pair_cuts, rows.T, strict=True)]
    sizes = [len(cut) + 1 for cut in model.pair_cuts]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * sizes[b] + coarse[b], values, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    chance = 1 / (1 + np.exp(-total))
    promising = []
    for a in range(len(sizes)):
        for b in range(a + 1, len(sizes)):
            promising.append((_quadrants(grid(a, b, labels - chance), grid(a, b, chance * (1 - chance)))[0], a, b))
    model.pairs = [(a, b) for gain, a, b in sorted(promising, reverse=True)[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), values in zip(model.pairs, model.pair_tables, strict=True):
            chance = 1 / (1 + np.exp(-total))
            step = RATE * _quadrants(grid(a, b, labels - chance), grid(a, b, chance * (1 - chance)))[1]
            values += step
            total += step[coarse[a], coarse[b]]
    return model


def train(docs: DataFrame, labels: DataFrame, sample_limit: int = SAMPLE_LIMIT) -> AdditiveModel:
    """Learn from labelled rows whose crc32 of the id leaves a remainder by 5; the others stay unseen."""
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    return fit(*labelled_features(docs, label_sample(labels, "quality", sample_limit, learn)))


def score(docs: DataFrame, model: AdditiveModel, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the column ``name`` added (replaced if it is there): the chance of label 1."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(matrix(text_stats(texts))))

    return docs.withColumn(name, scored.asNondeterministic()(raw(text)))


def quality_classifier(spark, sf_dir) -> DataFrame:
    """Every document's id, whether it was held out, its score and the predicted label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
