"""Contributions of features to the predictions of tree ensembles, exact for every row.

A fitted ensemble is a table of nodes. The contribution of a feature is its Shapley value in
the game where a known feature follows the row and an unknown one splits the weight of a node
over its children by the rows that trained them. For one leaf that game is a product over the
features on its path: o = 1 if the row passes all of the feature's splits (else 0), z = share
of training rows that do. With v the leaf's value, feature i adds

    v * (o_i - z_i) * integral over t in [0, 1] of the product over j <> i of (z_j (1 - t) + o_j t),

and Gauss-Legendre quadrature of half as many points as features gives that integral exactly.
Rows of a batch that pass the same features of a leaf share one evaluation.

Contributions and the base value add up to the prediction. Missing numbers and categories unknown
to a split go right, as in the learner. A single leaf has no contributions; a node table is as
large as its model and is sent to every task, rows stay where they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import new_path

# Columns of a node table; a leaf has feature -1, a numeric split sends values up to the threshold left.
NODE_FIELDS = ("tree int, weight double, node int, feature int, threshold double, categories array<double>, "
               "left int, right int, value double, cover double")
# Patterns of passed features up to which a table by pattern beats a search.
TABLE_BITS = 12


def tree_nodes(model: Model) -> DataFrame:
    """The nodes of an MLlib forest or boosted regression model, one row each.

    ``cover`` is the weight of the training rows that came by. A forest's trees weigh alike.
    """
    spark = SparkSession.active()
    path = new_path(spark, "trees")
    model.save(path)
    trees = spark.read.parquet(f"{path}/treesMetadata")
    id_, _, weight = trees.columns
    share = F.col(weight) if isinstance(model, GBTRegressionModel) else F.lit(1.0 / model.getNumTrees)
    weights = trees.select(F.col(id_).alias("treeID"), share.alias("weight"))
    n, split = F.col("nodeData"), F.col("nodeData.split")
    numeric = split["numCategories"] == -1
    return spark.read.parquet(f"{path}/data").join(weights, "treeID").select(
        F.col("treeID").alias("tree"), "weight", n["id"].alias("node"), split["featureIndex"].alias("feature"),
        F.when((split["featureIndex"] >= 0) & numeric, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when((split["featureIndex"] >= 0) & ~numeric, split["leftCategoriesOrThreshold"]).alias("categories"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("value"),
        n["impurityStats"][0].alias("cover"))


@dataclass
class Leaf:
    """A leaf: its weighted value, and for each feature of its path the share z and its (split, goes left)."""

    value: float
    features: np.ndarray
    shares: np.ndarray
    turns: list[list[tuple[int, bool]]]


class Ensemble:
    """Trees as arrays, from the rows of a node table."""

    def __init__(self, rows: list):
        by_tree: dict[int, dict[int, object]] = {}
        for r in rows:
            by_tree.setdefault(r["tree"], {})[r["node"]] = r
        self.splits: list[tuple[int, float | None, np.ndarray | None]] = []
        self.leaves: list[Leaf] = []
        # The base value, and the part of it that trees without a split give.
        self.base = self.alone = 0.0
        for nodes in by_tree.values():
            children = {c for r in nodes.values() if r["feature"] >= 0 for c in (r["left"], r["right"])}
            root = next(k for k in nodes if k not in children)
            waiting: list[tuple[int, dict[int, tuple[float, list]]]] = [(root, {})]
            while waiting:
                k, path = waiting.pop()
                r = nodes[k]
                if r["feature"] < 0:
                    self.add_leaf(r["weight"] * r["value"], path)
                    continue
                at = len(self.splits)
                known = None if r["categories"] is None else np.array(sorted(r["categories"]))
                self.splits.append((r["feature"], r["threshold"], known))
                share, turns = path.get(r["feature"], (1.0, []))
                for child, left in ((r["left"], True), (r["right"], False)):
                    part = nodes[child]["cover"] / r["cover"]
                    waiting.append((child, {**path, r["feature"]: (share * part, [*turns, (at, left)])}))

    def add_leaf(self, value: float, path: dict) -> None:
        shares = np.array([z for z, _ in path.values()])
        self.base += value * shares.prod()
        if not path:
            self.alone += value
        else:
            self.leaves.append(Leaf(value, np.array(list(path)), shares, [turns for _, turns in path.values()]))

    def goes_left(self, x: np.ndarray) -> list[np.ndarray]:
        """For every split, which rows go left."""
        return [np.isin(x[:, f], known) if known is not None else x[:, f] <= threshold
                for f, threshold, known in self.splits]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The prediction for every row of ``x``."""
        out = np.full(len(x), self.alone)
        left = self.goes_left(x)
        for leaf in self.leaves:
            passes = np.ones(len(x), bool)
            for at, goes in (turn for turns in leaf.turns for turn in turns):
                passes &= left[at] if goes else ~left[at]
            out[passes] += leaf.value
        return out

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """One row per row of ``x`` and one column per feature."""
        out = np.zeros(x.shape)
        left = self.goes_left(x)
        for leaf in self.leaves:
            code = np.zeros(len(x), np.int64)
            for k, turns in enumerate(leaf.turns):
                passes = np.ones(len(x), bool)
                for at, goes in turns:
                    passes &= left[at] if goes else ~left[at]
                code |= passes.astype(np.int64) << k
            m = len(leaf.features)
            if m <= TABLE_BITS:
                codes = np.flatnonzero(np.bincount(code, minlength=1 << m))
                place = np.zeros(1 << m, np.int64)
                place[codes] = np.arange(len(codes))
                row = place[code]
            else:
                codes, row = np.unique(code, return_inverse=True)
            passed = (codes[:, None] >> np.arange(m)[None, :] & 1).astype(float)
            out[:, leaf.features] += shapley_of_leaf(leaf.value, passed, leaf.shares)[row]
        return out


def shapley_of_leaf(value: float, passed: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Contributions of a leaf's features; ``passed`` has a row per pattern and a column per feature."""
    points, weights = np.polynomial.legendre.leggauss((len(shares) + 1) // 2)
    t, w = (points + 1) / 2, weights / 2
    parts = shares[None, :, None] * (1 - t) + passed[:, :, None] * t
    others = parts.prod(axis=1, keepdims=True) / parts
    return value * (passed - shares) * (others * w).sum(axis=2)


def explain(df: DataFrame, nodes: DataFrame, vector: Column, keys: list[str]) -> DataFrame:
    """(keys, base, values, contributions) of every row of ``df``; arrays are in the order of the features.

    ``vector`` is an array of numbers. ``nodes`` is collected: it is as large as the model.
    """
    shared = df.sparkSession.sparkContext.broadcast(nodes.collect())

    def run(batches):
        ensemble = Ensemble(shared.value)
        for batch in batches:
            values = batch.column(batch.num_columns - 1)
            x = values.values.to_numpy(zero_copy_only=False)[
                values.offsets[0].as_py():values.offsets[-1].as_py()].reshape(batch.num_rows, -1)
            found = ensemble.contributions(x)
            ends = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(x), ensemble.base)),
                 pa.ListArray.from_arrays(ends, pa.array(found.ravel()))],
                names=[*batch.schema.names, "base", "contributions"])

    rows = df.select(*[F.col(f"`{k}`") for k in keys], vector.alias("values"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    made = rows.mapInArrow(run, f"{fields}, base double, contributions array<double>")
    return made.select(*[F.col(f"`{k}`") for k in keys], "base", "values", "contributions")


def explain_vectors(df: DataFrame, nodes: DataFrame, keys: list[str], features: str = "features") -> DataFrame:
    """``explain`` for a column of feature vectors."""
    return explain(df, nodes, vector_to_array(features), keys)


def long_form(explained: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """(keys, feature, value, contribution), the shape the summary and dependence tables read."""
    names = F.array(*[F.lit(f) for f in features])
    cells = F.zip_with(names, F.arrays_zip("values", "contributions"), lambda name, c: F.struct(
        name.alias("feature"), c["values"].alias("value"), c["contributions"].alias("contribution")))
    return explained.select(*[F.col(f"`{k}`") for k in keys], F.inline(cells))
