import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelcast.operators import attribution, linear, promo
from panelcast.session import materialize

X = ["x1", "x2", "x3"]


def design(n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 50.0, 0.01]
    return x, 3 + x @ [2.0, -0.1, 40.0] + rng.normal(size=n)


def frame(spark, parts):
    rows = []
    for name, x, y in parts:
        for i, (row, target) in enumerate(zip(x, y)):
            rows.append((name, dt.date(2000, 1, 1) + dt.timedelta(days=i // 3), i % 3,
                         *[None if np.isnan(v) else float(v) for v in row], float(target)))
    names = [f"x{i + 1}" for i in range(len(rows[0]) - 4)]
    schema = "family string, date date, store_nbr int, " + ", ".join(f"{c} double" for c in names) + ", sales double"
    return materialize(spark.createDataFrame(rows, schema))


def lstsq(x, y):
    x = np.where(np.isnan(x), np.nanmedian(x, axis=0), x)
    beta = np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(), rcond=None)[0]
    return beta, y.mean() - x.mean(axis=0) @ beta


@pytest.mark.parametrize("wide", [False, True])
def test_ols_equals_numpy(spark, monkeypatch, wide):
    if wide:
        monkeypatch.setattr(linear, "WIDE", 1)
    plain, holes = design(200), design(90, 1)
    holes[0][::7, 1] = np.nan
    collinear = design(120, 2)
    collinear[0][:, 2] = 2 * collinear[0][:, 0]
    flat = design(60, 3)
    flat[0][:, 0] = 5.0
    parts = [("plain", *plain), ("holes", *holes), ("collinear", *collinear), ("flat", *flat), ("tiny", *design(12, 4))]
    models = linear.grouped_ols(frame(spark, parts), ["family"], X).collect()
    got = {r["family"]: r for r in models}
    assert "tiny" not in got
    for name, x, y in parts[:4]:
        beta, intercept = lstsq(x, y)
        np.testing.assert_allclose(got[name]["coefs"], beta, rtol=1e-6, atol=1e-8)
        assert got[name]["intercept"] == pytest.approx(intercept, rel=1e-6)
        assert got[name]["mean_y"] == pytest.approx(y.mean())


def test_contiguous_folds(spark):
    """Day borders and fold borders do not meet: some days are split between folds."""
    rows = [("A", dt.date(2000, 1, 1) + dt.timedelta(days=i // 5), i % 5) for i in range(53)]
    rows += [("B", dt.date(2000, 1, 1), i) for i in range(13)] + [("C", dt.date(2000, 1, 1), 0)]
    df = materialize(spark.createDataFrame(rows, "family string, date date, store_nbr int"))
    got = linear.contiguous_folds(df, ["family"]).orderBy("family", "date", "store_nbr").collect()
    for family, n in (("A", 53), ("B", 13), ("C", 1)):
        want = np.concatenate([np.full(len(p), i) for i, p in enumerate(np.array_split(np.arange(n), 5))])
        assert [r["cv"] for r in got if r["family"] == family] == want.tolist()


def test_lasso_equals_elastic_net(spark):
    x, y = design(150, 5)
    df = frame(spark, [("A", x, y)])
    for alpha in (0.01, 0.5):
        kept = {r["feature"]: r["coef"] for r in linear.grouped_lasso(df, ["family"], X, alphas=(alpha,)).collect()}
        # MLlib scales the penalty and the features in the same way when it standardizes.
        fit = LinearRegression(labelCol="sales", elasticNetParam=1.0, regParam=alpha / np.std(y) * np.std(y),
                               standardization=True, tol=1e-12, maxIter=1000, solver="l-bfgs")
        model = fit.fit(VectorAssembler(inputCols=X, outputCol="features").transform(df))
        want = dict(zip(X, model.coefficients.toArray()))
        for c in X:
            assert kept.get(c, 0.0) == pytest.approx(want[c], rel=2e-2, abs=1e-3)


def brute_lasso(x, y, alphas):
    """Coordinate descent on the data itself, folds as contiguous fifths."""
    z = (x - x.mean(axis=0)) / x.std(axis=0)

    def fit(z, y, alpha):
        z, y, w = z - z.mean(axis=0), y - y.mean(), np.zeros(z.shape[1])
        for _ in range(3000):
            for j in range(len(w)):
                r = y - z @ w + z[:, j] * w[j]
                rho = z[:, j] @ r / len(y)
                w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (z[:, j] @ z[:, j] / len(y))
        return w

    errors = []
    for alpha in alphas:
        e = []
        for part in np.array_split(np.arange(len(y)), 5):
            keep = np.setdiff1d(np.arange(len(y)), part)
            w = fit(z[keep], y[keep], alpha)
            e.append(((y[part] - y[keep].mean() - (z[part] - z[keep].mean(axis=0)) @ w) ** 2).mean())
        errors.append(np.mean(e))
    alpha = alphas[int(np.argmin(errors))]
    return alpha, fit(z, y, alpha)


def test_lasso_cross_validation_equals_brute_force(spark):
    x, y = design(120, 6)
    y = 3 + 2 * x[:, 0] + np.random.default_rng(7).normal(size=120) * 3
    rows = linear.grouped_lasso(frame(spark, [("A", x, y)]), ["family"], X).collect()
    alpha, w = brute_lasso(x, y, linear.ALPHAS)
    assert {r["alpha"] for r in rows} == {alpha}
    got = {r["feature"]: (r["coef_scaled"], r["coef"]) for r in rows}
    for j, c in enumerate(X):
        scaled, raw = got.get(c, (0.0, 0.0))
        assert scaled == pytest.approx(w[j], rel=1e-5, abs=1e-6)
        assert raw == pytest.approx(w[j] / x[:, j].std(), rel=1e-5, abs=1e-5)


def test_linear_oof_equals_numpy(spark):
    rng = np.random.default_rng(8)
    days = pd.date_range("2000-01-01", periods=60)
    rows = [(d.date(), s, f, float(rng.normal()), None if rng.random() < 0.1 else float(rng.normal()),
             "xyz"[s % 3] if i < 50 or s else "new", float(rng.normal(5)))
            for i, d in enumerate(days) for s in range(4) for f in ("A", "B")]
    df = materialize(spark.createDataFrame(
        rows, "date date, store_nbr int, family string, a double, b double, city string, sales double"))
    segments = spark.createDataFrame([("A", "High"), ("B", "Low")], "family string, segment string")
    fold = [(1, "2000-01-01", "2000-02-10", "2000-02-11", "2000-02-29")]
    got = linear.linear_oof(df, fold, segments).toPandas().sort_values(["date", "store_nbr"])
    assert set(got["family"]) == {"A"}
    p = df.toPandas()
    p["date"] = pd.to_datetime(p["date"])
    train, test = p[p["date"] <= "2000-02-10"], p[(p["date"] > "2000-02-10") & (p["family"] == "A")]
    test = test[test["date"] <= "2000-02-29"].sort_values(["date", "store_nbr"])

    def matrix(part):
        cols = [part["a"], part["b"].fillna(train["b"].median())] + [(part["city"] == c).astype(float) for c in "xyz"]
        return np.column_stack(cols)

    beta, intercept = lstsq(matrix(train), train["sales"].to_numpy())
    np.testing.assert_allclose(got["y_pred"], intercept + matrix(test) @ beta, rtol=1e-8)


def test_what_if_and_baseline(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(120):
        d = dt.date(2000, 1, 1) + dt.timedelta(days=i)
        promo_n, weekend = int(rng.integers(0, 3)), int(d.weekday() >= 5)
        rows.append((d, 1, "A", promo_n, weekend, 0, promo_n * weekend, 0, 10.0 + 4 * promo_n + 2 * promo_n * weekend))
    df = materialize(spark.createDataFrame(
        rows, "date date, store_nbr int, family string, onpromotion int, is_weekend int, is_holiday int, "
              "promo_weekend int, promo_holiday int, sales double"))
    features = ["onpromotion", "promo_weekend", "promo_holiday"]
    got = linear.promo_what_if(df, features, "2000-04-01", "2000-04-29").collect()
    for r in got:
        weekend = r["date"].weekday() >= 5
        want = 10.0 if r["scenario"] == "no_promo" else 14.0 + 2 * weekend
        assert r["sales_pred"] == pytest.approx(want)
    daily = linear.baseline_vs_actual(df, features, "2000-04-01", "2000-04-29").collect()
    assert len(daily) == 29
    assert all(r["baseline"] == pytest.approx(10.0) and (r["promo_flag"] == 1) == (r["actual"] > 10.0) for r in daily)
    assert linear.baseline_vs_actual(df, features, "2000-02-01", "2000-02-29").count() == 0  # 31 training rows only


def test_uplift_identity(spark):
    coefs = spark.createDataFrame([("A", "High", 2.0, -1.0, 0.5, 10.0), ("B", "Low", 1.0, 3.0, 0.0, 0.0)],
                                  "family string, segment string, coef_promo double, coef_promo_weekend double, "
                                  "coef_promo_holiday double, mean_sale double")
    got = {r["family"]: r for r in promo.promo_uplift(coefs).collect()}
    assert got["A"]["uplift_weekend_pct"] == pytest.approx(100 * 1.0 / (10 + 1e-9))
    assert got["A"]["uplift_max_pct"] == pytest.approx(100 * 2.5 / (10 + 1e-9))
    assert got["B"]["uplift_max_pct"] == pytest.approx(100 * 4.0 / 1e-9)
    assert {r["family"]: r["promo_uplift_pct"] for r in promo.promo_elasticity(coefs).collect()} == {"A": 20.0, "B": None}


def test_contributions_add_up(spark):
    x, y = design(80, 10)
    df = frame(spark, [("A", x, y)])
    models = linear.grouped_ols(df, ["family"], X)
    rows = attribution.contributions(df, models, ["family"], X, ["date", "store_nbr"])
    total = rows.groupBy("date", "store_nbr").agg(F.sum("contribution").alias("c"))
    scored = linear.predict(df, models, ["family"], X).join(total, ["date", "store_nbr"])
    worst = scored.select(F.max(F.abs(F.col("y_pred") - F.col("c") - F.lit(float(y.mean()))))).first()[0]
    assert worst < 1e-8


def test_quantiles_never_cross_or_go_below_zero(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 100.0)], "family string, p double")
    offsets = spark.createDataFrame([("A", -5.0, 2.0, 1.0)], "family string, q05 double, q50 double, q95 double")
    got = sorted((r["q05"], r["q50"], r["q95"]) for r in linear.add_quantiles(df, offsets, ["family"], "p").collect())
    assert got == [(0.0, 3.0, 3.0), (95.0, 102.0, 102.0)]
