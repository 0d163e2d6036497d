"""Permuted columns keep their values, in one range or many, and importance tells used columns from others."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelcast.operators import attribution


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(1200).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c")).withColumn(
        "sales", 3 * F.col("a") + F.col("b")).cache()


@pytest.mark.parametrize("range_rows", [2_000_000, 100])
def test_every_value_is_used_once(table, range_rows):
    got = attribution.shuffled(table, ["a", "b"], ["id"], range_rows=range_rows).collect()
    assert sorted((r.id, r.a) for r in got) == sorted((r.id, r.a) for r in table.collect())
    assert sorted((r["__p_a"], r["__p_b"]) for r in got) == sorted((r.a, r.b) for r in got)
    assert sum(r["__p_a"] == r.a for r in got) < 20


def test_rows_with_equal_keys_are_kept(spark):
    df = spark.createDataFrame([(1, float(k)) for k in range(30)], "id long, a double")
    assert sorted(r["__p_a"] for r in attribution.shuffled(df, ["a"], ["id"]).collect()) == [float(k) for k in range(30)]
    assert attribution.shuffled(df.where("false"), ["a"], ["id"]).count() == 0


def test_importance_follows_the_coefficients(table):
    stages = [VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), LinearRegression(labelCol="sales")]
    model = Pipeline(stages=stages).fit(table)
    whole = attribution.permutation_importance(model, table, ["a", "b", "c"], ["id"]).collect()
    assert [r.feature for r in whole] == ["a", "b", "c"]
    assert whole[0].importance == pytest.approx(3 * whole[1].importance, rel=0.15) and abs(whole[2].importance) < 1e-6
    ranges = attribution.permutation_importance(model, table, ["a", "b", "c"], ["id"], range_rows=100).collect()
    assert [(r.feature, round(r.importance, 9)) for r in ranges] == [(r.feature, round(r.importance, 9)) for r in whole]
