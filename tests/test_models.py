"""Daily series models and trees: fixed properties on made series, and better than the mean."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions import metrics as M
from panelcast.operators import additive, arx, trees
from panelcast.session import materialize


def daily(spark, families):
    rows = []
    for name, values in families.items():
        for i, v in enumerate(values):
            d = dt.date(2000, 1, 1) + dt.timedelta(days=i)
            rows.append((name, d, float(v), i % 4, int(d.day == 1), 50.0 + i % 10))
    return materialize(spark.createDataFrame(
        rows, "family string, date date, sales double, onpromotion int, is_holiday int, dcoilwtico double"))


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(0)
    n = 500
    t = np.arange(n)
    weekly = 100 + 20 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 2, n)
    ar = np.zeros(n)
    for i in range(1, n):
        ar[i] = 0.7 * ar[i - 1] + rng.normal()
    return daily(spark, {"weekly": weekly, "ar": 50 + ar, "trend": 10 + 0.5 * t + rng.normal(0, 1, n),
                         "short": rng.normal(10, 1, 130), "flat": np.full(200, 5.0), "tiny": rng.normal(10, 1, 100), "nearly": rng.normal(10, 1, 66)})


def scores(forecast):
    sums = M.error_sums(forecast, ["family"], lower="lower", upper="upper")
    rows = sums.select("family", M.mae().alias("mae"), M.coverage().alias("cov"), F.col("n")).collect()
    return {r["family"]: r for r in rows}


def test_arx(series):
    forecast, orders = arx.seasonal_arx(series, 60)
    forecast = materialize(forecast)
    got = scores(forecast)
    assert {r["n"] for r in got.values()} == {60}
    assert got["weekly"]["mae"] < 4 and got["trend"]["mae"] < 6 and got["flat"]["mae"] < 1e-6
    assert got["ar"]["mae"] < 4 and got["ar"]["cov"] > 75 and got["weekly"]["cov"] > 75
    assert forecast.where("y_pred < 0 or lower < 0 or lower > upper").count() == 0
    status = {r["family"]: (r["status"], r["Order"], r["Seasonal_Order"]) for r in orders.collect()}
    assert status["short"][0] == "fitted"
    # Forty training days carry no candidate: the default order is fitted on them, with a band.
    assert status["tiny"] == ("default", "(1, 1, 1)", "(0, 1, 1, 7)")
    assert status["nearly"][0] == "no terms"
    width = forecast.where("family = 'tiny'").agg(F.min(F.col("upper") - F.col("lower"))).first()[0]
    assert width > 1 and got["tiny"]["cov"] > 50
    assert status["ar"][0] == "fitted" and status["ar"][2].endswith(", 7)")


def test_arx_candidates_equal_regressions_on_the_design(spark, series):
    design = materialize(arx.prepare(series.where("family = 'ar'"), 60))
    rows = {(r["p"], r["q"], r["sp"], r["sq"]): r for r in arx.candidates(design).collect()}
    assert len(rows) == 4 * 4 * 3 * 3
    p = design.where("not is_test").toPandas().dropna(subset=["w", *arx.FULL])
    for order, names in {(1, 0, 0, 0): ["w_1"], (2, 1, 0, 1): ["w_1", "w_2", "e_1", "e_7"]}.items():
        cols = [*names, *arx.DX]
        x = np.column_stack([np.ones(len(p)), p[cols]])
        beta, *_ = np.linalg.lstsq(x, p["w"], rcond=None)
        sse = ((p["w"] - x @ beta) ** 2).sum()
        assert rows[order]["aic"] == pytest.approx(len(p) * np.log(sse / len(p)) + 2 * (len(cols) + 1), rel=1e-6)
        got = dict(zip(arx.FULL, rows[order]["coefs"]))
        np.testing.assert_allclose([got[c] for c in cols], beta[1:], rtol=1e-4, atol=1e-7)


def test_stable():
    assert arx.stable(np.array([0.7, 0, 0]), np.array([0.0, 0.0]))
    assert not arx.stable(np.array([1.2, 0, 0]), np.array([0.0, 0.0]))


def test_psi_weights_of_a_random_walk():
    assert arx.psi_weights(np.zeros(13), 1, 0, 5).tolist() == [1, 1, 1, 1, 1]
    weights = np.zeros(13)
    weights[0] = 0.5
    np.testing.assert_allclose(arx.psi_weights(weights, 0, 0, 4), [1, 0.5, 0.25, 0.125])


def test_additive(series):
    forecast, parts = additive.additive_forecast(series, 60)
    got = scores(forecast)
    assert got["weekly"]["mae"] < 4 and got["trend"]["mae"] < 6
    assert got["weekly"]["cov"] > 80
    total = sum((F.col(f"part_{n}") for n in additive.PARTS), F.lit(0.0))
    assert parts.where(F.abs(total - F.col("yhat")) > 1e-6).count() == 0
    swing = parts.where("family = 'weekly'").agg((F.max("part_weekly") - F.min("part_weekly")).alias("s")).first()["s"]
    assert 30 < swing < 50


FOLD = (1, "2000-01-01", "2000-09-30", "2000-10-01", "2000-12-31")


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(366):
        d = dt.date(2000, 1, 1) + dt.timedelta(days=i)
        for s in range(3):
            for f, level in (("A", 80.0), ("B", 40.0), ("C", 1.5)):
                promo = int(rng.integers(0, 3))
                sales = max(0.0, round(level * (1 + 0.3 * promo) * (1 + 0.2 * (d.weekday() >= 5)) + rng.normal(0, 2), 2))
                rows.append((d, s, f, sales, promo, 100.0, f"city_{s}", "st", f"t{s % 2}", s, 50.0, 0,
                             d.weekday(), int(d.strftime("%V")), d.month, d.year, int(d.weekday() >= 5),
                             level, level, None if i < 30 else level))
    schema = ("date date, store_nbr int, family string, sales double, onpromotion int, transactions double, "
              "city string, state string, type string, cluster int, dcoilwtico double, is_holiday int, "
              "day_of_week int, week_of_year int, month int, year int, is_weekend int, sales_lag_7 double, "
              "sales_lag_14 double, rolling_mean_30 double")
    return materialize(spark.createDataFrame(rows, schema))


def r2_of(oof):
    return M.error_sums(oof, []).select(M.r2("c").alias("r2")).first()["r2"]


def test_two_tier_forest(panel):
    oof = materialize(trees.two_tier_forest(panel, ["A"], [FOLD], trees=10, core_depth=6, rest_depth=6))
    assert oof.count() == 92 * 9 and oof.where("y_pred < 0").count() == 0
    assert {r["family"] for r in oof.select("family").distinct().collect()} == {"A", "B", "C"}
    assert r2_of(oof) > 0.8


def test_boosted_oof_uses_categories(spark, panel):
    oof = materialize(trees.boosted_oof(panel, [FOLD], iterations=15, depth=4, step=0.3))
    assert oof.count() == 92 * 9 and r2_of(oof) > 0.9
    from panelcast.operators.encode import apply_label, fit_label

    mapping = materialize(fit_label(panel, ["family"]))
    marked = materialize(trees.nominal(apply_label(panel, mapping, ["family"]), mapping, ["family"]))
    assert marked.schema["family"].metadata["ml_attr"] == {"type": "nominal", "num_vals": 3}


def test_medium_models(spark, panel):
    segments = spark.createDataFrame([("A", "Medium"), ("B", "Medium"), ("C", "Low")], "family string, segment string")
    train, test = trees.prepare_medium(panel, segments, FOLD, {2000: 1.5})
    assert train.select("weight").distinct().collect() == [(1.5,)]
    model, scored = trees.forest_fit_predict(train, test, 1, trees=10, depth=6)
    assert r2_of(scored) > 0.7
    names = [r["Feature"] for r in trees.importance(model.stages[-1], trees.MEDIUM_FEATURES, spark).collect()]
    assert sorted(names) == sorted(trees.MEDIUM_FEATURES)
    _, boosted = trees.boosted_fit_predict(train, test, 1, iterations=20, depth=4, step=0.3)
    assert r2_of(boosted) > 0.7


def test_hurdle(spark):
    df = spark.createDataFrame([(0.5, float(np.log1p(10.0))), (0.2, -1.0)], "p double, a double")
    got = [r[0] for r in df.select(trees.hurdle(F.col("p"), F.col("a"))).collect()]
    assert got == [pytest.approx(5.0), 0.0]


def test_best_round_waits_for_patience():
    assert trees.best_round([5.0, 4.0, 4.5, 3.0, 3.5, 3.6], patience=2) == 4
    assert trees.best_round([5.0, 4.0, 4.5, 4.6, 1.0], patience=2) == 2
    assert trees.best_round([5.0]) == 1


def test_rounds_serve_an_additive_target(spark):
    """Two additive steps need more than one tree; more rounds bring the loss down."""
    rows = [(dt.date(2000, 1, 1) + dt.timedelta(days=i // 8), float(i % 2), float(i // 2 % 2), 10.0 * (i % 2) + 3.0 * (i // 2 % 2))
            for i in range(1600)]
    table = materialize(spark.createDataFrame(rows, "date date, a double, b double, sales double").withColumn("fold", F.lit(1)))
    errors = []
    for rounds in (2, 25):
        boost = trees.GBTRegressor(labelCol="sales", maxIter=rounds, maxDepth=1, stepSize=0.3, seed=1)
        model = trees.fit_with_validation(boost, table, ["a", "b"])
        errors.append(model.transform(table).agg(F.avg(F.abs(F.col("sales") - F.col("prediction")))).first()[0])
    assert model.stages[-1].getNumTrees > 5
    assert errors[1] < 0.5 * errors[0]


def test_kept_trees_are_the_first_rounds(spark, panel):
    """After a cut the model scores as one that was fitted for so many rounds."""
    train = materialize(panel.select("sales", F.col("store_nbr").cast("double").alias("s"), F.col("onpromotion").cast("double").alias("o")))
    vectors = trees.assembler(["s", "o"]).transform(train)
    long, short = (trees.GBTRegressor(labelCol="sales", maxIter=n, maxDepth=2, seed=3).fit(vectors) for n in (8, 3))
    cut = trees.first_trees(long, 3)
    difference = cut.transform(vectors).agg(F.sum("prediction")).first()[0] - short.transform(vectors).agg(F.sum("prediction")).first()[0]
    assert cut.getNumTrees == 3 and abs(difference) < 1e-6


@pytest.mark.parametrize("sales", [0.0, 4.0])
def test_hurdle_of_families_that_never_or_always_sell(spark, panel, sales):
    rows = materialize(panel.withColumn("sales", F.lit(sales)))
    got = materialize(trees.hurdle_forest(rows, ["A"], FOLD, trees=2, depth=2))
    assert got.count() == 92 * 6
    assert [r[0] for r in got.select("y_pred").distinct().collect()] == [pytest.approx(sales)]
