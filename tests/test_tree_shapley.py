"""Tree contributions against all feature subsets, MLlib's own predictions and odd rows."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from panelcast.operators import attribution, tree_shapley

NAMES = ["a", "b", "c", "d", "e", "g"]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(800).select(
        "id", (F.rand(1) * 3).alias("a"), F.floor(F.rand(2) * 5).alias("b", metadata={"ml_attr": {"type": "nominal", "num_vals": 5}}),
        F.rand(3).alias("c"), F.round(F.rand(4) * 4).alias("d"), F.rand(5).alias("e"),
        F.floor(F.rand(6) * 3).alias("g", metadata={"ml_attr": {"type": "nominal", "num_vals": 3}}))
    df = df.withColumn("y", F.col("a") * F.col("b") + F.sin(F.col("c") * 9) * F.col("d") + (F.col("g") == 1).cast("int") * F.col("e") * 4)
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).cache()


def models(table):
    yield GBTRegressor(labelCol="y", maxIter=6, maxDepth=4, seed=3, subsamplingRate=0.7).fit(table)
    yield RandomForestRegressor(labelCol="y", numTrees=5, maxDepth=7, seed=3).fit(table)
    yield RandomForestRegressor(labelCol="y", numTrees=1, maxDepth=0, seed=3).fit(table)


def expected_value(nodes, k, x, known):
    """Mean prediction of a tree where only the features in ``known`` follow the row."""
    r = nodes[k]
    if r["feature"] < 0:
        return r["value"]
    value = x[r["feature"]]
    left = value in r["categories"] if r["categories"] is not None else value <= r["threshold"]
    if r["feature"] in known:
        return expected_value(nodes, r["left"] if left else r["right"], x, known)
    return sum(nodes[c]["cover"] / r["cover"] * expected_value(nodes, c, x, known) for c in (r["left"], r["right"]))


def brute(rows, x):
    trees = {}
    for r in rows:
        trees.setdefault(r["tree"], {})[r["node"]] = r

    def game(known):
        return sum(t[0]["weight"] * expected_value(t, 0, x, known) for t in trees.values())

    m, out = len(x), []
    for i in range(m):
        rest = [j for j in range(m) if j != i]
        out.append(sum(
            math.factorial(len(s)) * math.factorial(m - len(s) - 1) / math.factorial(m) * (game({*s, i}) - game(set(s)))
            for n in range(m) for s in itertools.combinations(rest, n)))
    return out, game(set())


def test_equals_all_subsets_and_adds_up(table):
    for model in models(table):
        rows = tree_shapley.tree_nodes(model).collect()
        got = tree_shapley.explain_vectors(model.transform(table), tree_shapley.tree_nodes(model), ["id", "prediction"]).collect()
        assert len(got) == 800
        for r in got:
            assert math.isclose(r.base + sum(r.contributions), r.prediction, abs_tol=1e-9)
        for r in got[:12]:
            want, base = brute(rows, r["values"])
            assert np.allclose(r.contributions, want, atol=1e-9) and math.isclose(r.base, base, abs_tol=1e-9)


def test_missing_numbers_go_right():
    row = dict(tree=0, weight=1.0, threshold=None, categories=None, left=-1, right=-1, feature=-1)
    nodes = [{**row, "node": 0, "feature": 0, "threshold": 0.5, "left": 1, "right": 2, "value": 0.0, "cover": 4.0},
             {**row, "node": 1, "value": 1.0, "cover": 1.0}, {**row, "node": 2, "value": 5.0, "cover": 3.0}]
    ensemble = tree_shapley.Ensemble(nodes)
    got = ensemble.contributions(np.array([[np.nan], [0.5], [0.6]]))
    assert ensemble.base == 4.0 and got.ravel().tolist() == [1.0, -3.0, 1.0]


def deep_nodes(depth, n_features, seed):
    """A tree that splits on a drawn feature at every level of one long path."""
    draw = random.Random(seed)
    rows, cover = [], 2.0 ** depth
    row = dict(tree=0, weight=0.5, threshold=None, categories=None, left=-1, right=-1, feature=-1)
    for k in range(depth):
        rows.append({**row, "node": 2 * k, "feature": draw.randrange(n_features), "threshold": draw.random(), "left": 2 * k + 1,
                     "right": 2 * k + 2, "value": 0.0, "cover": cover})
        part = draw.uniform(0.2, 0.8)
        rows.append({**row, "node": 2 * k + 1, "value": draw.gauss(0, 1), "cover": cover * (1 - part)})
        cover *= part
    rows.append({**row, "node": 2 * depth, "value": 3.0, "cover": cover})
    return rows


def test_long_paths_and_repeated_features():
    rows = deep_nodes(14, 9, 1)
    ensemble = tree_shapley.Ensemble(rows)
    x = np.random.default_rng(0).random((5, 9))
    for r, got in zip(x, ensemble.contributions(x)):
        want, base = brute(rows, r)
        assert np.allclose(got, want, atol=1e-9) and math.isclose(ensemble.base, base, abs_tol=1e-12)


def test_more_features_than_the_table_of_patterns(monkeypatch):
    rows = deep_nodes(20, 30, 2)
    x = np.random.default_rng(1).random((50, 30))
    by_search = tree_shapley.Ensemble(rows).contributions(x)
    monkeypatch.setattr(tree_shapley, "TABLE_BITS", 30)
    assert np.allclose(by_search, tree_shapley.Ensemble(rows).contributions(x), atol=1e-12)


def test_summary_and_dependence(table):
    model = GBTRegressor(labelCol="y", maxIter=3, maxDepth=3, seed=3).fit(table)
    explained = tree_shapley.explain_vectors(table, tree_shapley.tree_nodes(model), ["id"])
    rows = tree_shapley.long_form(explained, NAMES, ["id"])
    summary = attribution.contribution_summary(rows).collect()
    assert {r.feature for r in summary} == set(NAMES) and summary[0].importance >= summary[-1].importance >= 0
    assert attribution.dependence(rows, "a").count() == 800
    assert tree_shapley.explain_vectors(table.where("false"), tree_shapley.tree_nodes(model), ["id"]).count() == 0
