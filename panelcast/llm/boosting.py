"""Boosted trees fitted by MLlib, as arrays that score NumPy batches inside tasks."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

# Fixed settings of the fits; the seed makes a fit repeatable on the same rows.
ROUNDS = 40
DEPTH = 4
STEP = 0.2
SEED = 5


def fit(train: DataFrame, features: list[str], label: str, rounds: int = ROUNDS, depth: int = DEPTH) -> list[dict]:
    """Trees of a boosted classifier of ``label`` (0 or 1); rows and columns are plain numbers.

    With one class only, or no rows, there is nothing to tell apart and no tree.
    """
    if train.select(label).distinct().count() < 2:
        return []
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(train)
    model = GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=STEP, minInstancesPerNode=5,
                          seed=SEED).fit(vectors)
    return [tree(t, w) for t, w in zip(model.trees, model.treeWeights)]


def tree(fitted, weight: float) -> dict:
    """A tree as arrays: feature (-1: leaf), threshold, left and right child, value."""
    rows: list[list] = []

    def walk(node) -> int:
        at = len(rows)
        rows.append([-1, 0.0, 0, 0, weight * node.prediction()])
        if node.subtreeDepth() > 0:
            rows[at][:2] = [node.split().featureIndex(), node.split().threshold()]
            rows[at][2] = walk(node.leftChild())
            rows[at][3] = walk(node.rightChild())
        return at

    walk(fitted._java_obj.rootNode() if hasattr(fitted, "_java_obj") else fitted._call_java("rootNode"))
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return dict(zip(("feature", "threshold", "left", "right", "value"),
                    (np.array(c, dtype=k) for c, k in zip(zip(*rows), kinds))))


def margin(trees: list[dict], x: np.ndarray) -> np.ndarray:
    """Sum of the trees' values for every row of ``x``; above 0 speaks for label 1."""
    total = np.zeros(len(x))
    every = np.arange(len(x))
    for t in trees:
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            feature = t["feature"][at]
            inner = feature >= 0
            if not inner.any():
                break
            left = x[every, np.maximum(feature, 0)] <= t["threshold"][at]
            at = np.where(inner, np.where(left, t["left"][at], t["right"][at]), at)
        total += t["value"][at]
    return total


def probability(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-2 * np.clip(margins, -300, 300)))
