import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions import metrics as M
from panelcast.operators import aggregates as A
from panelcast.operators import reports

CASES = {
    "plain": ([3.0, 0.0, 5.0, 10.0], [2.0, 1.0, 5.5, 7.0]),
    "constant": ([4.0, 4.0, 4.0], [4.0, 4.0, 5.0]),
    "constant_perfect": ([4.0, 4.0], [4.0, 4.0]),
    "zeros": ([0.0, 0.0], [0.0, 1.0]),
    "zeros_perfect": ([0.0, 0.0], [0.0, 0.0]),
    "single": ([2.0], [3.0]),
}


@pytest.fixture(scope="module")
def table(spark):
    rows = [(name, y, p) for name, (ys, ps) in CASES.items() for y, p in zip(ys, ps)]
    return spark.createDataFrame(rows, "g string, y_true double, y_pred double")


def values(sums, column):
    return {r["g"]: r["v"] for r in sums.select("g", column.alias("v")).collect()}


def expected(fn):
    return {name: fn(np.array(y), np.array(p)) for name, (y, p) in CASES.items()}


def same(got, want):
    for name, w in want.items():
        g = got[name]
        if w is None or (isinstance(w, float) and math.isnan(w)):
            assert g is None, (name, g)
        else:
            assert g == pytest.approx(w, rel=1e-9), name


def r2(constant):
    def fn(y, p):
        if y.min() == y.max():
            return constant(y, p)
        return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()

    return fn


VARIANTS = [
    (lambda: M.mae(), lambda y, p: np.abs(y - p).mean()),
    (lambda: M.rmse(), lambda y, p: np.sqrt(((y - p) ** 2).mean())),
    (lambda: M.mape("a"), lambda y, p: 100 * (np.abs(y - p)[y != 0] / y[y != 0]).mean() if (y != 0).any() else None),
    (lambda: M.mape("b"), lambda y, p: 100 * (np.abs(y - p) / np.where(y == 0, 1, y)).mean()),
    (lambda: M.mape("c"), lambda y, p: 100 * (np.abs(y - p)[y > 0] / y[y > 0]).mean() if (y > 0).any() else 0.0),
    (lambda: M.mape("d"), lambda y, p: 100 * (np.abs(y - p) / np.maximum(y, 1e-6)).mean()),
    (lambda: M.mape("e"), lambda y, p: (np.abs(y - p) / np.maximum(np.abs(y), np.finfo(float).eps)).mean()),
    (lambda: M.mape("f"), lambda y, p: 100 * (np.abs(y - p)[y > 0] / y[y > 0]).mean() if (y > 0).any() else None),
    (lambda: M.wape("a"), lambda y, p: np.abs(y - p).sum() / np.abs(y).sum() if np.abs(y).sum() else None),
    (lambda: M.wape("b"), lambda y, p: np.abs(y - p).sum() / y.sum() if y.sum() else 0.0),
    (lambda: M.wape("c"), lambda y, p: np.abs(y - p).mean() / y.mean() if y.mean() else 0.0),
    (lambda: M.wape("d"), lambda y, p: np.abs(y - p).mean() / y.mean() if y.mean() > 0 else None),
    (lambda: M.r2("a"), r2(lambda y, p: 0.0)),
    (lambda: M.r2("b"), r2(lambda y, p: None)),
    (lambda: M.r2("c"), r2(lambda y, p: None if len(y) < 2 else float((y == p).all()))),
    (lambda: M.accuracy("b", "c"), lambda y, p: max(0.0, 100 - (100 * (np.abs(y - p)[y > 0] / y[y > 0]).mean() if (y > 0).any() else 0.0))),
    (lambda: M.accuracy("c"), lambda y, p: 100 * (np.abs(y - p) <= 0.2 * np.maximum(y, 1e-6)).mean()),
    (lambda: M.accuracy("d"), lambda y, p: 100 * (np.abs(y - p) <= 0.2 * np.abs(y)).mean()),
    (lambda: M.accuracy("e"), lambda y, p: 100 * np.mean([b == 0 if a == 0 else abs(a - b) / a <= 0.2 for a, b in zip(y, p)])),
    (lambda: M.accuracy("f"), lambda y, p: (100.0 if np.abs(y - p).sum() == 0 else 0.0) if np.abs(y).sum() == 0
     else 100 * (1 - np.abs(y - p).sum() / np.abs(y).sum())),
    (lambda: M.residual_std(), lambda y, p: (y - p).std(ddof=1) if len(y) > 1 else 0.0),
]


@pytest.mark.parametrize("i", range(len(VARIANTS)))
def test_variant(table, i):
    ours, want = VARIANTS[i]
    same(values(M.error_sums(table, ["g"]), ours()), expected(want))


def test_pooled_sums_equal_direct_sums(spark, sf_dir):
    from panelcast.plans.panel import stand_in_predictions

    oof = stand_in_predictions(spark, sf_dir).cache()
    fine = M.error_sums(oof, ["family", "fold"])
    metrics = [M.mae().alias("mae"), M.rmse().alias("rmse"), M.mape("b").alias("mape"), M.r2("c").alias("r2"),
               M.residual_std().alias("sd"), M.accuracy("e").alias("acc")]
    for by in ([], ["fold"]):
        direct = M.error_sums(oof, by).select(*by, *metrics).orderBy(*by or ["mae"]).toPandas()
        pooled = M.pool(fine, by).select(*by, *metrics).orderBy(*by or ["mae"]).toPandas()
        np.testing.assert_allclose(pooled.to_numpy(float), direct.to_numpy(float), rtol=1e-9)


def test_unused_sums_are_pruned(table):
    plan = M.error_sums(table, ["g"]).select("g", M.mae())._jdf.queryExecution().optimizedPlan().toString()
    assert "var_pop" not in plan and "ratio" not in plan


def test_normal_band(spark):
    rng = np.random.default_rng(2)
    y, p = rng.normal(10, 3, 200), rng.normal(10, 3, 200)
    df = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(y, p)], "g string, y_true double, y_pred double")
    sums = M.error_sums(df, ["g"])
    for spread, s in ((M.residual_std(), (y - p).std(ddof=1)), (M.rmse(), np.sqrt(((y - p) ** 2).mean()))):
        row = M.normal_band(df, sums, ["g"], spread).select(M.coverage().alias("c"), M.avg_width().alias("w")).first()
        assert row["c"] == pytest.approx(100 * (np.abs(y - p) <= 1.96 * s).mean())
        assert row["w"] == pytest.approx(2 * 1.96 * s)


def test_all_folds_row_is_pooled_and_overall_row_is_a_mean(spark):
    rows = [("A", "High", f, float(y), float(y + f)) for f in (1, 2) for y in range(1, 5 * f)]
    oof = spark.createDataFrame(rows, "family string, segment string, fold int, y_true double, y_pred double")
    report = {r["fold"]: r for r in reports.linear_fold_report(oof).collect()}
    assert report["Overall (5 folds)"]["MAE"] == pytest.approx((1 + 2) / 2)
    pooled = M.pool(M.error_sums(oof, ["fold"]), []).select(M.mae().alias("m")).first()["m"]
    assert pooled == pytest.approx((4 * 1 + 9 * 2) / 13)


def test_quantile_report_keeps_empty_folds(spark):
    rows = [(1, "A", 3.0, 1.0, 2.0, 4.0)]
    preds = spark.createDataFrame(rows, "fold int, family string, y_true double, q05 double, q50 double, q95 double")
    folds = [(i, "2000-01-01", "2000-01-02", "2000-01-03", "2000-01-04") for i in (1, 2)]
    got = {r["fold"]: r for r in reports.quantile_fold_report(preds, folds).collect()}
    assert got[1]["coverage_95"] == 100.0 and got[1]["avg_width"] == 3.0
    assert got[2]["MAE"] is None and got[2]["coverage_95"] is None


def test_pinball(spark):
    df = spark.createDataFrame([(10.0, 8.0), (8.0, 10.0)], "y double, p double")
    loss = df.select(M.pinball("y", "p", 0.95).alias("l")).agg(F.avg("l")).first()[0]
    assert loss == pytest.approx((0.95 * 2 + 0.05 * 2) / 2)


def test_correlation_of_a_constant_side_is_null(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (1, 2.0, 5.0), (2, 1.0, 2.0), (2, 2.0, 4.0)],
                               "cluster int, sales double, dcoilwtico double")
    assert [(r["cluster"], round(r["corr_sales_oil"], 9)) for r in A.oil_correlation(df).collect()] == [(2, 1.0)]


def test_incomplete_rows_count_nowhere_and_null_groups_stay(spark):
    rows = [("a", 1.0, 2.0), ("a", 5.0, None), ("a", None, 3.0), (None, 2.0, 2.5), (None, 4.0, 4.0)]
    table = spark.createDataFrame(rows, "g string, y_true double, y_pred double")
    sums = M.error_sums(table, ["g"])
    got = {r["g"]: r for r in sums.select("g", "n", "sum_y", M.mae().alias("mae")).collect()}
    assert (got["a"]["n"], got["a"]["sum_y"], got["a"]["mae"]) == (1, 1.0, 1.0)
    banded = M.normal_band(table, sums, ["g"], M.residual_std())
    assert {r["g"] for r in banded.collect()} == {"a", None}
