import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import encode, quantiles, ranking
from panelcast.session import materialize


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one group, many ties, some nulls."""
    rng = np.random.default_rng(3)
    hot = np.where(rng.random(20_000) < 0.4, 0.0, rng.exponential(50, 20_000).round(3))
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in rng.normal(0, 1, 7_000)]
    rows += [("few", 1.0), ("few", 4.0), ("few", None), ("none", None)]
    return materialize(spark.createDataFrame(rows, "g string, v double").repartition(8)), rows


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 0.99, 1.0])
@pytest.mark.parametrize("accuracy,range_rows", [(10_000, 2_000_000), (100, 2_000_000), (100, 50)])
def test_exact_quantile(skewed, q, accuracy, range_rows):
    df, rows = skewed
    got = quantiles.exact_quantiles(df, ["g"], {"x": ("v", q)}, accuracy, range_rows)
    got = {r["g"]: r["x"] for r in got.collect()}
    for g in ("hot", "cold", "few"):
        want = np.quantile([v for k, v in rows if k == g and v is not None], q)
        assert got[g] == pytest.approx(want, rel=1e-12, abs=1e-12)
    assert got.get("none") is None


def test_global_quantile_and_floor(spark):
    df = materialize(spark.createDataFrame([(0.1,), (0.2,)], "sales double"))
    assert quantiles.target_scale(df).first()["scale"] == 1.0


def test_clip_outliers_keeps_floor(spark):
    rows = [("A", float(v)) for v in range(100)] + [("B", 1.0), ("B", 2.0), ("B", None)]
    df = materialize(spark.createDataFrame(rows, "family string, sales double"))
    got = quantiles.clip_outliers(df).groupBy("family").agg(F.max("sales").alias("m"), F.count(F.lit(1)).alias("n"))
    got = {r["family"]: (r["m"], r["n"]) for r in got.collect()}
    assert got["A"] == (pytest.approx(np.quantile(range(100), 0.99)), 100)
    assert got["B"] == (2.0, 3)


@pytest.mark.parametrize("range_rows", [2_000_000, 20])
def test_ordinal_is_dense_and_sorted(spark, range_rows):
    values = [f"v{i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", "x"), ("b", "x"), ("b", "y")], "f string, v string")
    got = ranking.ordinal(df, ["f"], "v", "code", range_rows).collect()
    assert {(r["f"], r["v"]): r["code"] for r in got} == {
        **{("a", v): i for i, v in enumerate(sorted(values))}, ("b", "x"): 0, ("b", "y"): 1}


def test_text_codes_sort_as_text_and_native_codes_as_numbers(spark):
    df = spark.createDataFrame([(9,), (10,), (2,)], "n int")
    text = {r["value"]: r["code"] for r in encode.fit_label(df, ["n"]).collect()}
    assert text == {"10": 0, "2": 1, "9": 2}
    native = {r["value"]: r["code"] for r in encode.fit_ordinal(df, ["n"]).collect()}
    assert native == {"2": 0, "9": 1, "10": 2}


def test_unknown_values(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    test = spark.createDataFrame([("a",), ("zz",), (None,)], "c string")
    mapping = encode.fit_label(train, ["c"])
    assert sorted(r["c"] for r in encode.apply_label(test, mapping, ["c"], unknown=-1).collect()) == [-1, -1, 0]
    hot = encode.one_hot(test.withColumnRenamed("c", "col"), {"col": ["a", "b"]}).where("col = 'zz'").first()
    assert (hot["a"], hot["b"]) == (0, 0)


def test_mode_tie_goes_to_the_lowest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    assert encode.impute_most_frequent(df, ["c"]).where("c = 'a'").count() == 3


def test_minmax_of_a_constant_is_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "a double, b double")
    assert sorted((r["a"], r["b"]) for r in encode.minmax(df, ["a", "b"]).collect()) == [(0.0, 0.0), (0.0, 1.0)]


def test_standardize_of_a_constant(spark):
    df = spark.createDataFrame([("g", 5.0, 1.0), ("g", 5.0, 3.0)], "g string, a double, b double")
    got = encode.standardize(df, ["a", "b"], ["g"]).collect()
    assert sorted((r["a"], r["b"]) for r in got) == [(0.0, -1.0), (0.0, 1.0)]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(50_000).withColumnRenamed("id", "k")
    first = {r["k"] for r in ranking.sample_n(df, 500, ["k"]).collect()}
    again = {r["k"] for r in ranking.sample_n(df.repartition(13), 500, ["k"]).collect()}
    assert len(first) == 500 and first == again
    assert first != {r["k"] for r in ranking.sample_n(df, 500, ["k"], seed=7).collect()}
    assert ranking.sample_n(df, 60_000, ["k"]).count() == 50_000


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None)], "k string, v double")
    assert [r["k"] for r in ranking.top_k(df, "v", 2, ["k"]).collect()] == ["a", "b"]
