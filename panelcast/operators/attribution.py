"""What the features contribute to predictions."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.linear import filled
from panelcast.operators.ranking import RANGE_ROWS, running_total, top_k
from panelcast.session import materialize


def contributions(df: DataFrame, models: DataFrame, by: list[str], features: list[str], keys: list[str]) -> DataFrame:
    """(keys, feature, value, contribution): coef * (value - group mean), exact for a linear model."""
    table = models.select(*by, "coefs", "mean_x", "fill_x")
    values = filled(features)
    cells = [
        F.struct(F.lit(c).alias("feature"), values[i].alias("value"),
                 (F.col("coefs")[i] * (values[i] - F.col("mean_x")[i])).alias("contribution"))
        for i, c in enumerate(features)
    ]
    kept = list(dict.fromkeys([*keys, *by]))
    return df.join(table, by).select(*kept, F.explode(F.array(*cells)).alias("c")).select(*kept, "c.*")


def contribution_summary(rows: DataFrame, k: int | None = None) -> DataFrame:
    """Mean absolute contribution per feature, largest first; the top k if asked."""
    table = rows.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    return top_k(table, "importance", k, ["feature"]) if k else table.orderBy(F.desc("importance"), "feature")


def dependence(rows: DataFrame, feature: str) -> DataFrame:
    """(value, contribution) pairs of one feature."""
    return rows.where(F.col("feature") == feature).drop("feature")


def shuffled(df: DataFrame, columns: list[str], keys: list[str], seed: int = 42, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` with ``__p_<column>`` for each column: the columns' values of another row, each row's used once.

    Rows are ranked in two seeded orders by ranges of bounded length, and a row takes the values
    of the row that has its rank in the other order. The columns move together.
    """
    def place(s: int) -> Column:
        return F.struct(F.xxhash64(F.lit(s), *keys).alias("hash"), F.col("__row").alias("row"))

    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "permutation_rows")
    placed = materialize(rows.withColumns({"__one": place(seed), "__two": place(seed + 1)}), "permutation_places")
    one = running_total(placed, [], "__one", F.lit(1), "__rank", range_rows).drop("__one", "__two", "__row")
    values = placed.select("__two", *[F.col(c).alias(f"__p_{c}") for c in columns])
    two = running_total(values, [], "__two", F.lit(1), "__rank", range_rows).drop("__two")
    return one.join(two, "__rank").drop("__rank")


def permutation_importance(model: Model, rows: DataFrame, features: list[str], keys: list[str],
                           y: str = "sales", seed: int = 42, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rise of the RMSE over ``rows`` when one feature's values are dealt out in another order.

    ``model`` starts from the raw feature columns. Every permuted copy is scored in the same pass.
    """
    paired = materialize(shuffled(rows, features, keys, seed, range_rows), "permutation_pairs")
    copies = paired.select("*", F.explode(F.array(*[F.lit(c) for c in ["", *features]])).alias("__which"))
    dealt = copies.withColumns({
        c: F.when(F.col("__which") == c, F.col(f"__p_{c}")).otherwise(F.col(c)) for c in features
    }).drop(*[f"__p_{c}" for c in features])
    error = F.col("prediction") - F.col(y)
    rmse = materialize(model.transform(dealt).groupBy("__which").agg(F.sqrt(F.avg(error * error)).alias("rmse")), "permutation_rmse")
    base = rmse.where("__which = ''").select(F.col("rmse").alias("base"))  # one row
    return rmse.where("__which <> ''").join(base).select(
        F.col("__which").alias("feature"), (F.col("rmse") - F.col("base")).alias("importance")
    ).orderBy(F.desc("importance"), "feature")
