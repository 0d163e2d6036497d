import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import folds, windows


def series(spark, values, store=1, family="A", start="2000-01-01"):
    day = dt.date.fromisoformat(start)
    rows = [(day + dt.timedelta(days=i), store, family, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double")


@pytest.fixture(scope="module")
def two(spark):
    rng = np.random.default_rng(1)
    return series(spark, rng.integers(0, 50, 35)).unionByName(series(spark, rng.integers(0, 50, 40), store=2))


def test_lags_and_rolling_equal_pandas(spark, two):
    got = windows.series_select(two, [*windows.add_lags([7, 14]), *windows.add_rolling([7, 30], "mean"),
                                      *windows.add_rolling([7, 30], "std")]).toPandas()
    got = got.sort_values(["store_nbr", "date"]).reset_index(drop=True)
    sales = got.groupby("store_nbr")["sales"]
    for k in (7, 14):
        pd.testing.assert_series_equal(got[f"sales_lag_{k}"], sales.shift(k), check_names=False)
    for k in (7, 30):
        before = sales.shift(1).groupby(got["store_nbr"]).rolling(k)
        np.testing.assert_allclose(got[f"rolling_mean_{k}"], before.mean().to_numpy(), equal_nan=True)
        np.testing.assert_allclose(got[f"rolling_std_{k}"], before.std().to_numpy(), equal_nan=True)
        assert got.groupby("store_nbr")[f"rolling_mean_{k}"].apply(lambda s: s.isna().sum()).tolist() == [k, k]


def test_one_shuffle_serves_all_series_features(two):
    df = windows.series_select(two, [*windows.add_lags([7, 14, 30]), *windows.add_rolling([7, 30], "mean")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_sequences(spark, two):
    df = windows.make_sequences(two.withColumn("x", F.col("sales") * 2), ["sales", "x"], 30)
    assert df.groupBy("store_nbr").count().orderBy("store_nbr").collect() == [(1, 5), (2, 10)]
    row = df.where("store_nbr = 1").orderBy("date").first()
    past = [r["sales"] for r in two.where("store_nbr = 1").orderBy("date").collect()]
    assert [s[0] for s in row["sequence"]] == past[:30]
    assert row["sequence"][4][1] == past[4] * 2
    assert row["target"] == past[30]
    assert windows.make_sequences(series(spark, range(30)), ["sales"], 30).count() == 0


def test_interpolate_both_ends(spark):
    rows = [(dt.date(2000, 1, i + 1), "A", v) for i, v in enumerate([None, 2.0, None, None, 8.0, None])]
    rows += [(dt.date(2000, 1, 1), "B", None)]
    df = spark.createDataFrame(rows, "date date, family string, oil double")
    got = windows.interpolate(df, "oil", ["family"]).orderBy("family", "date")
    assert [r["oil"] for r in got.collect()] == [2.0, 2.0, 4.0, 6.0, 8.0, 8.0, 0.0]


def test_fill_calendar(spark):
    df = series(spark, [5, 6, 7]).where("date <> date'2000-01-02'").withColumn("oil", F.lit(1.0))
    got = windows.fill_calendar(df, ["family"], ["sales"]).orderBy("date").collect()
    assert [(r["date"].day, r["sales"], r["oil"]) for r in got] == [(1, 5.0, 1.0), (2, 0.0, None), (3, 7.0, 1.0)]


def test_holdout_drops_short_series(spark):
    df = series(spark, range(10)).unionByName(series(spark, range(3), store=2))
    got = windows.holdout_last(df, 3, ["store_nbr"])
    assert got.groupBy("store_nbr", "is_test").count().orderBy("is_test").collect() == [(1, False, 7), (1, True, 3)]


def test_duplicate_keys(spark):
    df = series(spark, range(3)).unionByName(series(spark, range(1)))
    assert windows.duplicate_keys(df, ["date", "store_nbr", "family"]).count() == 1


FOLDS = [(1, "2000-01-01", "2000-01-20", "2000-01-21", "2000-01-25"),
         (2, "2000-01-01", "2000-01-25", "2000-01-26", "2000-01-31")]


def test_folds(spark):
    df = folds.assign_folds(series(spark, range(40)), FOLDS)
    counts = {(r["fold"], r["split"]): r["count"] for r in df.groupBy("fold", "split").count().collect()}
    assert counts == {(1, "train"): 20, (1, "test"): 5, (2, "train"): 25, (2, "test"): 6}
    tests = folds.assign_test_fold(series(spark, range(40)), FOLDS)
    assert tests.groupBy("date").count().where("count > 1").count() == 0
    assert tests.count() == 11


def test_fold_assignment_does_not_shuffle(spark):
    plan = folds.assign_folds(series(spark, range(40)), FOLDS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_validation_cut(spark):
    train = folds.assign_folds(series(spark, range(40)), FOLDS).where("split = 'train'")
    marked = folds.validation_cut(train, 10, min_rows=5)
    assert {r["fold"]: r["count"] for r in marked.where("is_validation").groupBy("fold").count().collect()} == {1: 10, 2: 10}
    # Too few validation rows, or nothing left to train on: no validation at all.
    assert folds.validation_cut(train, 10, min_rows=11).where("is_validation").count() == 0
    assert folds.validation_cut(train, 100, min_rows=1).where("is_validation").count() == 0
