"""Categories as numbers: the mean target of the rows before, in a seeded order.

A row's own target and those behind it never enter its number, so a learner cannot read the
target off it. Rows are ordered by a seeded checksum of their key. The order is cut into
chunks by the checksum's first digits, so a chunk of a category has a bounded number of rows
whatever the category holds: totals per category and chunk are made map-side, running sums
over chunks start each chunk, and only rows of one chunk are sorted together.

Cases: a null category is a category; null targets add nothing; rows with equal key come in
any order; a category's first row gets the prior, the mean target of its group; a category
that training rows lack gets the prior; a group without any target gives null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import join_null_safe
from panelcast.session import materialize

CHUNK_ROWS = 1_000_000
# Hexadecimal digits of the checksum that choose the chunk.
DIGITS = 6


def seeded_order(keys: list[str], seed: int) -> Column:
    """Text that orders rows the same on every run; another seed gives another order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))


def smoothed(total: Column, n: Column, prior: Column, weight: float) -> Column:
    """Mean of ``n`` targets that sum to ``total`` and of ``weight`` priors."""
    return (total + weight * prior) / (n + F.lit(weight))


def group_priors(df: DataFrame, by: list[str], y: str) -> DataFrame:
    """(by, __prior): the mean target of each group."""
    return materialize(df.withColumn("__all", F.lit(1)).groupBy("__all", *by).agg(F.avg(y).alias("__prior")), "priors")


def with_prior(df: DataFrame, priors: DataFrame, by: list[str]) -> DataFrame:
    return join_null_safe(df.withColumn("__all", F.lit(1)), priors, ["__all", *by]).drop("__all")


def ordered_means(df: DataFrame, columns: list[str], y: str, keys: list[str], by: list[str] = (), seed: int = 42,
                  weight: float = 1.0, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with ``<column>_mean`` for each column: the smoothed mean of the rows before in the order.

    ``df`` is materialized. Categories are counted inside the groups ``by`` (a fold, say), which
    have their own priors.
    """
    by = list(by)
    priors = group_priors(df, by, y)
    out = with_prior(df.withColumn("__order", seeded_order(keys, seed)), priors, by)
    value = F.coalesce(F.col(y).cast("double"), F.lit(0.0))
    counted = F.col(y).isNotNull().cast("long")
    before = Window.unboundedPreceding, -1
    for column in columns:
        group = [*by, column]
        largest = df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
        chunks = -(-largest // chunk_rows) or 1
        place = F.conv(F.substring("__order", 1, DIGITS), 16, 10).cast("long")
        rows = materialize(out.withColumn("__chunk", F.floor(place * chunks / 16**DIGITS).cast("int")), "ordered_rows")
        sums = rows.groupBy(*group, "__chunk").agg(F.sum(value).alias("__s"), F.sum(counted).alias("__n"))
        across = Window.partitionBy(*group).orderBy("__chunk").rowsBetween(*before)
        starts = materialize(sums.select(
            *group, "__chunk", F.coalesce(F.sum("__s").over(across), F.lit(0.0)).alias("__s0"),
            F.coalesce(F.sum("__n").over(across), F.lit(0)).alias("__n0")), "chunk_starts")
        inside = Window.partitionBy(*group, "__chunk").orderBy("__order").rowsBetween(*before)
        total = F.col("__s0") + F.coalesce(F.sum(value).over(inside), F.lit(0.0))
        n = F.col("__n0") + F.coalesce(F.sum(counted).over(inside), F.lit(0))
        out = join_null_safe(rows, starts, [*group, "__chunk"]).withColumn(
            f"{column}_mean", smoothed(total, n, F.col("__prior"), weight)).drop("__chunk", "__s0", "__n0")
    return out.drop("__order", "__prior")


def fit_means(train: DataFrame, columns: list[str], y: str, by: list[str] = ()) -> DataFrame:
    """(by, feature, value, total, n): target sums of every category, for all columns at once."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]))
    return train.select(*by, F.col(y).cast("double").alias("__y"), cells.alias("c")).groupBy(*by, "c.feature", "c.value").agg(
        F.coalesce(F.sum("__y"), F.lit(0.0)).alias("total"), F.count("__y").alias("n"))


def apply_means(df: DataFrame, means: DataFrame, priors: DataFrame, columns: list[str], by: list[str] = (),
                weight: float = 1.0) -> DataFrame:
    """``df`` with ``<column>_mean`` from all training rows of ``fit_means`` and ``group_priors``."""
    out = with_prior(df, priors, list(by))
    for column in columns:
        names = [*by, "__value"]
        table = means.where(F.col("feature") == column).select(
            *by, F.col("value").alias("__value"), F.col("total").alias("__total"), F.col("n").alias("__n"))
        out = out.withColumn("__value", F.col(column).cast("string"))
        same = [out[c].eqNullSafe(table[c]) for c in names]
        joined = out.join(table, same, "left").select(*[out[c] for c in out.columns], "__total", "__n")
        out = joined.withColumn(f"{column}_mean", smoothed(
            F.coalesce("__total", F.lit(0.0)), F.coalesce("__n", F.lit(0)), F.col("__prior"), weight)).drop("__total", "__n", "__value")
    return out.drop("__prior")
