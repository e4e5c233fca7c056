"""Quality rules: gradient-boosted trees over document statistics.

The trees are learned level by level on binned statistics with a logistic loss. For the features of ``FALLING`` a
split is taken only if the score cannot rise with the feature, and the bound between the two sides holds for every
split below, so the whole score never rises with such a feature. The forest is flattened into numpy arrays (feature,
threshold, left, right, value): scoring moves all rows of a batch down one level at a time.

Learning uses at most ``sample_limit`` labelled rows chosen by a hash of the id; the verdict covers every row and its
whole text. Null and empty texts have zero counts and fail the base rule. Without labels of both classes the trees
keep everything the base rule keeps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import label_sample, raw, table
from sluicebox.llm.stats import COUNTS, FEATURES, labelled_features, matrix, text_stats

SAMPLE_LIMIT = 20_000
THRESHOLD = 0.3
BINS, ROUNDS, DEPTH, RATE, LEAST = 64, 80, 3, 0.2, 20
FALLING = ("symbol_ratio", "dup_line_ratio", "repeat_word_ratio", "bang_ratio", "bar_ratio", "stutter_ratio")


@dataclass
class Forest:
    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def total(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(DEPTH):
                goes_left = rows[every, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.total(rows), -30, 30)))


def _flat(base: float, trees: list[list[tuple]]) -> Forest:
    roots, nodes = [], []
    for tree in trees:
        at = len(nodes)
        roots.append(at)
        nodes += [(f, t, at + low, at + high, v) for f, t, low, high, v in tree]
    columns = list(zip(*nodes, strict=True)) if nodes else [[]] * 5
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return Forest(base, np.array(roots, np.int64), *(np.array(c, k) for c, k in zip(columns, kinds, strict=True)))


def fit(rows: np.ndarray, labels: np.ndarray, falling: tuple[str, ...] = FALLING) -> Forest:
    if not len(labels) or labels.min() == labels.max():
        return _flat(30.0 if not len(labels) or labels[0] else -30.0, [])
    cuts = [np.unique(np.quantile(column, np.arange(1, BINS) / BINS)) for column in rows.T]
    bins = np.stack([np.searchsorted(cut, column, side="left") for cut, column in zip(cuts, rows.T, strict=True)], 1)
    down = [name in falling for name in FEATURES]
    share = labels.mean()
    base = float(np.log(share / (1 - share)))
    total = np.full(len(labels), base)
    trees = []
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-total))
        tree = _grow(bins, cuts, down, labels - chance, chance * (1 - chance))
        trees.append(tree)
        total += _flat(0.0, [tree]).total(rows)
    return _flat(base, trees)


def _grow(bins, cuts, down, gradient, weight) -> list[tuple]:
    """One tree as (feature, threshold, left, right, value); a leaf points at itself."""
    nodes: list[tuple] = []

    def leaf(members: np.ndarray, low: float, high: float) -> float:
        return float(np.clip(gradient[members].sum() / (weight[members].sum() + 1), low, high))

    def build(members: np.ndarray, depth: int, low: float, high: float) -> int:
        at = len(nodes)
        nodes.append((0, np.inf, at, at, RATE * leaf(members, low, high)))
        best = None
        if depth < DEPTH and len(members) >= 2 * LEAST:
            for k, cut in enumerate(cuts):
                if not len(cut):
                    continue
                size = len(cut) + 1
                own = bins[members, k]
                g = np.bincount(own, gradient[members], size).cumsum()
                h = np.bincount(own, weight[members], size).cumsum()
                n = np.bincount(own, minlength=size).cumsum()
                left, right = g[:-1] / (h[:-1] + 1), (g[-1] - g[:-1]) / (h[-1] - h[:-1] + 1)
                gain = g[:-1] * left + (g[-1] - g[:-1]) * right - g[-1] ** 2 / (h[-1] + 1)
                gain[(n[:-1] < LEAST) | (n[-1] - n[:-1] < LEAST)] = -1
                if down[k]:
                    gain[np.clip(left, low, high) < np.clip(right, low, high)] = -1
                j = int(gain.argmax())
                if gain[j] > 1e-6 and (best is None or gain[j] > best[0]):
                    best = gain[j], k, j, float(np.clip(left[j], low, high)), float(np.clip(right[j], low, high))
        if best is not None:
            _, k, j, left, right = best
            goes = bins[members, k] <= j
            middle = (left + right) / 2
            bounds = ((middle, high), (low, middle)) if down[k] else ((low, high), (low, high))
            first = build(members[goes], depth + 1, *bounds[0])
            second = build(members[~goes], depth + 1, *bounds[1])
            nodes[at] = (k, float(cuts[k][j]), first, second, 0.0)
        return at

    build(np.arange(len(gradient)), 0, -np.inf, np.inf)
    return nodes


def train(docs: DataFrame, labels: DataFrame, sample_limit: int = SAMPLE_LIMIT) -> Forest:
    return fit(*labelled_features(docs, label_sample(labels, "quality", sample_limit, F.lit(True))))


def quality_rules(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with the struct ``rules`` added: the counts, the base rule, the learned score and the verdict."""
    kind = "struct<" + ", ".join(f"{name}: bigint" for name in COUNTS) + ", base_failed: boolean, score: double, kept: boolean>"

    @F.arrow_udf(kind)
    def judged(texts: pa.Array) -> pa.Array:
        stats = text_stats(texts)
        counts = [np.asarray(stats[name], np.int64) for name in COUNTS]
        words, repeats = counts[0], counts[-1]
        failed = (words < 10) | (100 * repeats > 20 * words)
        scores = forest.score(matrix(stats))
        values = [*counts, failed, scores, ~failed & (scores >= threshold)]
        return pa.StructArray.from_arrays([pa.array(v) for v in values], [*COUNTS, "base_failed", "score", "kept"])

    return docs.withColumn("rules", judged.asNondeterministic()(raw(text)))


def judge_documents(spark, sf_dir) -> DataFrame:
    """Every document with its counts, whether the base rule failed, and the verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, train(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *(F.col(f"rules.{name}") for name in (*COUNTS, "base_failed", "kept", "score")))
