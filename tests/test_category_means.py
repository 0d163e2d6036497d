"""Ordered category means against a loop over the rows, also for a category that holds most of them."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from panelcast.operators import category_means as M
from panelcast.session import materialize


def rows(n, seed=1):
    draw = random.Random(seed)
    return [(i, draw.choice([1, 2]), draw.choices(["hot", "b", "c", None], [70, 10, 10, 10])[0], draw.randrange(5),
             None if draw.random() < 0.1 else float(draw.randrange(50))) for i in range(n)]


SCHEMA = "id long, fold int, cat string, code int, y double"


def plain(data, column, weight):
    """(fold, id) -> mean of the rows before, one row after the other."""
    priors, seen, out = {}, {}, {}
    for fold in {r[1] for r in data}:
        values = [r[4] for r in data if r[1] == fold and r[4] is not None]
        priors[fold] = sum(values) / len(values)
    for r in sorted(data, key=lambda r: hashlib.md5(f"42|{r[0]}".encode()).hexdigest()):
        total, n = seen.get((r[1], r[column]), (0.0, 0))
        out[r[1], r[0]] = (total + weight * priors[r[1]]) / (n + weight)
        if r[4] is not None:
            seen[r[1], r[column]] = total + r[4], n + 1
    return out


@pytest.mark.parametrize("chunk_rows", [1_000_000, 40])
def test_equals_a_loop(spark, chunk_rows):
    data = rows(1500)
    table = materialize(spark.createDataFrame(data, SCHEMA))
    got = M.ordered_means(table, ["cat", "code"], "y", ["id"], ["fold"], weight=2.0, chunk_rows=chunk_rows)
    assert got.columns == [*table.columns, "cat_mean", "code_mean"]
    found = got.collect()
    assert len(found) == len(data)
    for name, column in (("cat_mean", 2), ("code_mean", 3)):
        want = plain(data, column, 2.0)
        assert all(math.isclose(r[name], want[r.fold, r.id], abs_tol=1e-9) for r in found)


def test_no_window_holds_a_whole_category(spark):
    table = materialize(spark.range(20_000).select("id", F.lit("hot").alias("cat"), F.col("id").cast("double").alias("y")))
    got = M.ordered_means(table, ["cat"], "y", ["id"], chunk_rows=500)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__chunk" in [w for w in plan.splitlines() if "Window" in w][0]
    assert got.count() == 20_000


def test_other_rows_get_all_training_rows(spark):
    train = materialize(spark.createDataFrame([(1, 1, "a", 0, 2.0), (2, 1, "a", 0, 4.0), (3, 1, None, 0, 9.0)], SCHEMA))
    test = spark.createDataFrame([(7, 1, "a", 0, None), (8, 1, None, 0, None), (9, 1, "new", 0, None)], SCHEMA)
    means, priors = M.fit_means(train, ["cat"], "y", ["fold"]), M.group_priors(train, ["fold"], "y")
    got = {r.id: r.cat_mean for r in M.apply_means(test, means, priors, ["cat"], ["fold"]).collect()}
    assert got == {7: (6 + 5) / 3, 8: (9 + 5) / 2, 9: 5.0}


def test_empty_and_no_targets(spark):
    table = spark.createDataFrame([(1, 1, "a", 0, None), (2, 1, "a", 0, None)], SCHEMA)
    assert [r.cat_mean for r in M.ordered_means(materialize(table), ["cat"], "y", ["id"]).collect()] == [None, None]
    assert M.ordered_means(materialize(table.where("false")), ["cat"], "y", ["id"]).count() == 0
