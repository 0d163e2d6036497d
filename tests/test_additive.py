"""Sparse bends of the trend and the sampled band."""

import datetime as dt
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import additive


def value(square, linear, weight, b):
    return b @ square @ b / 2 - linear @ b + weight * np.abs(b).sum()


@pytest.mark.parametrize("seed", range(8))
def test_sparse_minimum_equals_all_sign_patterns(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(30, 6)) + 3 * rng.normal(size=(30, 1))
    square, linear, weight = x.T @ x, x.T @ rng.normal(size=30) * 3, float(rng.uniform(1, 20))
    best = 0.0
    for signs in itertools.product((-1, 0, 1), repeat=6):
        at = np.flatnonzero(signs)
        b = np.zeros(6)
        if len(at):
            b[at] = np.linalg.solve(square[np.ix_(at, at)], linear[at] - weight * np.array(signs)[at])
        best = min(best, value(square, linear, weight, b))
    assert value(square, linear, weight, additive.sparse_minimum(square, linear, weight)) == pytest.approx(best, abs=1e-9)


def test_sparse_minimum_of_hinges_that_look_alike():
    t = np.linspace(0, 1, 1500)
    x = np.maximum(t[:, None] - np.arange(1, 26) / 32, 0)
    y = 3 * x[:, 9] - 5 * x[:, 17] + np.random.default_rng(0).normal(0, 0.02, len(t))
    square, linear, weight = x.T @ x / 4e-4, x.T @ y / 4e-4, 20.0
    b = additive.sparse_minimum(square, linear, weight)
    slope = square @ b - linear
    assert np.abs(slope[b == 0]).max() <= weight * (1 + 1e-6)
    np.testing.assert_allclose(slope[b != 0], -weight * np.sign(b[b != 0]), rtol=1e-5)
    assert 2 <= (b != 0).sum() <= 12


def test_sparse_minimum_of_nothing():
    assert not additive.sparse_minimum(np.zeros((25, 25)), np.zeros(25), 20.0).any()
    assert not additive.sparse_minimum(np.eye(25), np.full(25, 19.0), 20.0).any()


def daily(spark, series):
    first = dt.date(2001, 1, 1)
    rows = [(family, first + dt.timedelta(days=k), float(v), k % 3, int(k % 50 == 0), 40.0 + k % 7)
            for family, values in series.items() for k, v in enumerate(values)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["family", "date", "sales", *additive.EXOG]))


@pytest.fixture(scope="module")
def walks(spark):
    """Families whose trend keeps bending in the forecast days as it did before."""
    rng = np.random.default_rng(5)
    t = np.arange(1590) / 1499
    series = {}
    for k in range(24):
        later = 1 + rng.random(rng.poisson(additive.BENDS * (t[-1] - 1))) * (t[-1] - 1)
        places = np.concatenate([0.8 * np.arange(1, 26) / 26, later])
        trend = 3 + np.maximum(t[:, None] - places, 0) @ rng.laplace(0, 0.5, len(places))
        series[f"f{k:02d}"] = 100 * (trend + rng.normal(0, 0.05, len(t)))
    series["flat"] = 50 + rng.normal(0, 1, len(t))
    series["zero"] = np.zeros(len(t))
    series["one day"] = [5.0]
    return daily(spark, series)


def test_slopes_over_the_rows_are_those_of_a_minimum(walks):
    train, _, scales, models = additive.split_and_fit(walks, 90)
    got = {r["family"]: r for r in additive.optimality(train, scales, models).collect()}
    assert all(r["excess"] < 1e-4 for r in got.values())
    assert got["flat"]["n_bends"] <= additive.BENDS // 2 and got["zero"]["n_bends"] == 0
    assert got["flat"]["n_bends"] < np.mean([r["n_bends"] for f, r in got.items() if f.startswith(("f0", "f1", "f2"))])


def test_band_covers_and_widens(walks):
    forecast = additive.additive_forecast(walks, 90)[0].toPandas().sort_values(["family", "date"])
    assert (forecast["lower"] <= forecast["y_pred"]).all() and (forecast["y_pred"] <= forecast["upper"]).all()
    inside = forecast["y_true"].between(forecast["lower"], forecast["upper"])
    bending = forecast["family"].str.fullmatch(r"f\d+")
    assert inside[bending].mean() >= 0.85
    assert inside[forecast["family"] == "flat"].mean() >= 0.85
    far = additive.additive_forecast(walks, 400)[0].toPandas().sort_values(["family", "date"])
    width = (far["upper"] - far["lower"]).groupby(far["family"])
    wider = width.apply(lambda w: w.tail(20).mean() / w.head(20).mean())
    assert wider[wider.index.str.fullmatch(r"f\d+")].median() > 1.5
    assert wider["flat"] < wider[wider.index.str.fullmatch(r"f\d+")].median()


def test_band_is_the_same_each_time_and_centred(walks):
    some = walks.where(F.col("family").isin("f01", "flat"))
    one, two = (additive.additive_forecast(some, 90)[0].orderBy("family", "date").toPandas() for _ in range(2))
    pd.testing.assert_frame_equal(one, two)
    np.testing.assert_allclose(one["upper"] - one["y_pred"], one["y_pred"] - one["lower"], rtol=1e-9, atol=1e-9)


def test_draws_of_a_trend_without_noise_match_their_formula():
    """Variance of a day's bend effect: rate x 2 size^2 x (t - 1)^3 / 3."""
    days = pd.date_range("2001-01-01", periods=100)
    rows = pd.DataFrame({"family": "a", "date": days, "sales": 0.0, "yhat": 0.0, "t": 1 + np.arange(1, 101) / 100,
                         "sigma": 1e-9, "y_scale": 1.0, "bend_size": 0.1})
    got = additive.draw_band(rows)
    deviation = np.sqrt(additive.BENDS * 2 * 0.01 / 3)
    assert got["upper"].iloc[-1] == pytest.approx(1.96 * deviation, rel=0.15)


def test_empty_series(walks):
    forecast, parts = additive.additive_forecast(walks.where("false"), 90)
    assert forecast.count() == 0 and parts.count() == 0
