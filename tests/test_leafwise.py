"""Leaf-wise boosting against a version that splits one leaf at a time on plain arrays."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import leafwise, tree_shapley

FOLDS = [(1, "2000-01-01", "2000-06-30", "2000-07-01", "2000-07-31"), (2, "2000-01-01", "2000-07-31", "2000-08-01", "2000-08-31")]
FEATURES, SIZES = ["a", "b", "c"], {"c": 6}


def rows(n=4000, seed=1):
    draw = np.random.default_rng(seed)
    day = draw.integers(0, 244, n)
    a, b, c = draw.normal(size=n), draw.integers(0, 40, n).astype(float), draw.integers(0, 6, n)
    y = np.sin(2 * a) * (c % 3) + 0.1 * b * (c == 4) + draw.normal(scale=0.2, size=n)
    dates = [dt.date(2000, 1, 1) + dt.timedelta(days=int(d)) for d in day]
    return [(d, float(x), float(z), int(k), float(t)) for d, x, z, k, t in zip(dates, a, b, c, y)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), "date date, a double, b double, c int, sales double").repartition(5).cache()


def plain(data, columns, first, cut, last, rounds, leaves, rate, min_rows, patience):
    """(trees kept, score of every row): boosting in one array, one leaf after the other."""
    x = np.array([r[1:4] for r in data], float)
    y, day = np.array([r[4] for r in data]), np.array([leafwise.days(r[0]) for r in data])
    bins = columns.bins(x)
    train, late = (day >= first) & (day <= cut), (day > cut) & (day <= last)
    scores, losses, history = np.full(len(y), y[train].mean()), [], []
    for _ in range(rounds + 1):
        losses.append(((scores - y)[late] ** 2).mean() if late.any() else 0)
        history.append(scores.copy())
        best = int(np.argmin(losses))
        if late.any() and len(losses) - 1 - best >= patience:
            break
        g = scores - y
        groups = [train.copy()]
        everywhere = [np.ones(len(y), bool)]
        while len(groups) < leaves:
            found = []
            for i, rows_ in enumerate(groups):
                counts = np.zeros((2, int(columns.starts[-1])))
                for k in range(3):
                    counts[0] += np.bincount(columns.starts[k] + bins[rows_, k].astype(int), minlength=counts.shape[1])
                    counts[1] += np.bincount(columns.starts[k] + bins[rows_, k].astype(int), weights=g[rows_], minlength=counts.shape[1])
                s = leafwise.best_split(counts, columns, min_rows)
                if s:
                    found.append((s.gain, i, s))
            if not found:
                break
            _, i, s = max(found, key=lambda f: f[0])
            left = s.left[bins[:, s.column]]
            groups += [groups[i] & left, groups[i] & ~left]
            everywhere += [everywhere[i] & left, everywhere[i] & ~left]
            del groups[i], everywhere[i]
        for rows_, all_ in zip(groups, everywhere):
            scores = scores + np.where(all_, -rate * g[rows_].mean(), 0)
    best = int(np.argmin(losses)) if late.any() else rounds
    return best, history[best]


@pytest.mark.parametrize("leaves, rounds, patience", [(8, 5, 100), (31, 3, 100), (31, 25, 2), (2, 3, 100)])
def test_equals_one_leaf_at_a_time(spark, table, leaves, rounds, patience):
    settings = dict(rounds=rounds, leaves=leaves, bins=32, rate=0.3, patience=patience, min_rows=20)
    models = leafwise.fit(table, FEATURES, SIZES, FOLDS, **settings)
    columns = leafwise.fit_columns(table, FEATURES, SIZES, 32)
    data = rows()
    every = table.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("fold"))
    got = {(r.fold, r.a): r.y_pred for r in leafwise.predict(every, models, FEATURES, ["a"]).collect()}
    for k, first, last, *_ in FOLDS:
        n = leafwise.cut_date({r["date"]: r["count"] for r in table.groupBy("date").count().collect()}, FOLDS[k - 1])
        kept, scores = plain(data, columns, leafwise.days(first), leafwise.days(n), leafwise.days(last), rounds, leaves, 0.3, 20, patience)
        assert len({r["tree"] for r in models[k]}) == kept + 1
        assert np.allclose([got[k, r[1]] for r in data], scores, atol=1e-9)
    if patience == 2:
        assert any(len({r["tree"] for r in m}) < rounds for m in models.values())


def test_scores_are_written_now_and_then(table, monkeypatch):
    settings = dict(rounds=5, leaves=4, bins=16, rate=0.3)
    whole = leafwise.fit(table, FEATURES, SIZES, FOLDS[:1], **settings)
    monkeypatch.setattr(leafwise, "REWRITE", 2)
    again = leafwise.fit(table, FEATURES, SIZES, FOLDS[:1], **settings)
    assert [r["feature"] for r in whole[1]] == [r["feature"] for r in again[1]]
    assert np.allclose([r["value"] for r in whole[1]], [r["value"] for r in again[1]])


def test_folds_without_rows(spark, table):
    far = [(9, "1990-01-01", "1990-12-31", "1991-01-01", "1991-02-01"), FOLDS[0]]
    models = leafwise.fit(table, FEATURES, SIZES, far, rounds=2, leaves=4, bins=8)
    assert len(models[9]) == 1 and len(models[1]) > 1
    constant = table.withColumn("sales", F.lit(3.0))
    models = leafwise.fit(constant, FEATURES, SIZES, FOLDS[:1], rounds=2, leaves=4, bins=8)
    assert {r["feature"] for r in models[1]} == {-1}


def test_contributions_of_a_leafwise_model(spark, table):
    models = leafwise.fit(table, FEATURES, SIZES, FOLDS[:1], rounds=4, leaves=8, bins=16, rate=0.3)
    nodes = spark.createDataFrame(models[1], tree_shapley.NODE_FIELDS)
    scored = leafwise.predict(table.withColumn("fold", F.lit(1)), models, FEATURES, ["a", "b", "c"])
    vector = F.array(*[F.col(f).cast("double") for f in FEATURES])
    for r in tree_shapley.explain(scored, nodes, vector, ["y_pred"]).collect():
        assert abs(r.base + sum(r.contributions) - r.y_pred) < 1e-9
