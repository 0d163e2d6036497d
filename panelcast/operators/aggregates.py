"""Rollups, pivots, statistics and guards over the panel.

Groups are coarse (a family may hold a third of the rows), so everything here is an
aggregate with a map-side part; no group is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum0(c: str) -> Column:
    """Sum that is 0, not null, over nulls only."""
    return F.coalesce(F.sum(c), F.lit(0))


def daily_rollup(df: DataFrame, keys: list[str] = ("family",)) -> DataFrame:
    return df.groupBy(*keys, "date").agg(
        _sum0("sales").alias("sales"),
        _sum0("onpromotion").alias("onpromotion"),
        F.max("is_holiday").alias("is_holiday"),
        F.avg("dcoilwtico").alias("dcoilwtico"),
    )


def daily_actual_vs_pred(df: DataFrame, by: list[str], actual: str, predicted: str,
                         promo: str | None = None) -> DataFrame:
    """Actual and predicted totals per day, with a flag for any promotion that day."""
    aggregates = [_sum0(actual).alias("actual"), _sum0(predicted).alias("baseline")]
    if promo is not None:
        aggregates.append(F.max(F.when(F.col(promo) > 0, 1).otherwise(0)).alias("promo_flag"))
    return df.groupBy(*by, "date").agg(*aggregates)


def scenario_daily(df: DataFrame, by: list[str] = ("family",)) -> DataFrame:
    """Daily totals with one column per scenario."""
    return df.groupBy(*by, "date").pivot("scenario", ["no_promo", "with_promo"]).agg(F.sum("sales_pred"))


def promo_vs_nonpromo(df: DataFrame) -> DataFrame:
    """Mean sales with and without promotion by family and segment, and the uplift."""
    promo = F.col("onpromotion") > 0
    means = df.where("family is not null and segment is not null").groupBy("family", "segment").agg(
        F.avg(F.when(~promo | F.col("onpromotion").isNull(), F.col("sales"))).alias("avg_sales_nonpromo"),
        F.avg(F.when(promo, F.col("sales"))).alias("avg_sales_promo"),
    )
    gain = F.col("avg_sales_promo") - F.col("avg_sales_nonpromo")
    return means.withColumn("uplift_rel", F.try_divide(gain, F.col("avg_sales_nonpromo")))


def family_totals(df: DataFrame) -> DataFrame:
    return df.where("family is not null").groupBy("family").agg(_sum0("sales").alias("total_sales"))


def sales_heatmap(df: DataFrame, row: str) -> DataFrame:
    """Total sales by ``row`` and month, one column per month, 0 where nothing sold."""
    months = list(range(1, 13))
    wide = df.where(F.col(row).isNotNull()).groupBy(row).pivot("month", months).agg(_sum0("sales"))
    return wide.select(row, *[F.coalesce(F.col(str(m)), F.lit(0.0)).alias(f"m{m}") for m in months])


def daily_cluster(df: DataFrame) -> DataFrame:
    """Daily sales and mean oil price per cluster, days with a price only."""
    return (
        df.where("cluster is not null")
        .groupBy("date", "cluster")
        .agg(_sum0("sales").alias("sales"), F.avg("dcoilwtico").alias("dcoilwtico"))
        .na.drop(subset=["dcoilwtico"])
    )


def correlation(x: str, y: str) -> Column:
    """Pearson correlation; null, not an error, where a side is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def oil_correlation(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("cluster")
        .agg(correlation("sales", "dcoilwtico").alias("corr_sales_oil"))
        .na.drop(subset=["corr_sales_oil"])
    )


def sensitive_groups(corr: DataFrame, k: int = 3) -> DataFrame:
    """The k clusters with the strongest and the k with the weakest correlation."""
    strength = F.abs("corr_sales_oil")
    strong = corr.orderBy(strength.desc(), "cluster").limit(k).withColumn("kind", F.lit("sensitive"))
    weak = corr.orderBy(strength.asc(), "cluster").limit(k).withColumn("kind", F.lit("non_sensitive"))
    return strong.unionByName(weak)


def sensitivity_series(daily: DataFrame, picked: DataFrame) -> DataFrame:
    """Daily totals of the two sets of clusters; oil is the mean of the cluster means."""
    return (
        daily.join(picked.select("cluster", "kind"), "cluster")
        .groupBy("kind", "date")
        .agg(_sum0("sales").alias("sales"), F.avg("dcoilwtico").alias("dcoilwtico"))
    )


def feature_frequency(coefs: DataFrame, segments: DataFrame) -> DataFrame:
    """In how many families a feature was kept, as count and percent of all families."""
    total = segments.agg(F.count_distinct("family")).scalar()
    return (
        coefs.groupBy("feature")
        .agg(F.count_distinct("family").alias("n_families"))
        .withColumn("pct_families", F.try_divide(100.0 * F.col("n_families"), total))
    )


# The segments, in reading order.
SEGMENTS = ["High", "Medium", "Low", "Ultra-low"]


def feature_by_segment(coefs: DataFrame) -> DataFrame:
    """Families that kept a feature, one column per segment."""
    return (
        coefs.groupBy("feature").pivot("segment", SEGMENTS).agg(F.count_distinct("family")).na.fill(0)
    )


UPLIFTS = ["uplift_normal_pct", "uplift_weekend_pct", "uplift_holiday_pct", "uplift_max_pct"]


def uplift_by_segment(uplift: DataFrame) -> DataFrame:
    return uplift.where("segment is not null").groupBy("segment").agg(
        *[F.avg(c).alias(c) for c in UPLIFTS]
    )


# Metric columns of a comparison table.
COMPARED = ["WAPE", "R2", "MAE", "RMSE", "MAPE", "accuracy", "coverage_95", "avg_width", "mean_sale"]


def compare_models(perf: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """Mean of every metric the table carries, by model (and segment)."""
    return perf.groupBy(*by).agg(*[F.avg(c).alias(c) for c in COMPARED if c in perf.columns])


def compare_models_by_segment(perf: DataFrame, segments: list[str] = ("High", "Medium", "Low")) -> DataFrame:
    return compare_models(perf.where(F.col("segment").isin(list(segments))), ["segment", "model"])


def family_weights(df: DataFrame) -> DataFrame:
    """Family sales over the mean of family sales, for the families in ``df``."""
    totals = df.groupBy("family").agg(F.sum("sales").alias("total"))
    mean = totals.agg(F.avg("total")).scalar()
    return totals.select("family", F.try_divide(F.col("total"), mean).alias("weight"))


def having_count(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Rows of groups with at least n rows."""
    large = df.groupBy(*keys).count().where(F.col("count") >= n).select(*keys)
    return df.join(large, keys, "left_semi")


def fit_stats(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Minimum, maximum, mean and population deviation per column, in long form."""
    aggregates = [f(c).alias(f"{c}__{k}") for c in columns
                  for k, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_pop))]
    wide = df.groupBy(*by).agg(*aggregates)
    rows = [
        F.struct(F.lit(c).alias("feature"),
                 *[F.col(f"{c}__{k}").cast("double").alias(k) for k in ("min", "max", "mean", "std")])
        for c in columns
    ]
    return wide.select(*by, F.explode(F.array(*rows)).alias("s")).select(*by, "s.*")


def most_frequent(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Most frequent text per column (and group); a tie goes to the lowest value.

    Counts are taken per value first, so no task holds all values of a column.
    """
    keys = [*by, "feature"]
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    values = df.select(*by, cells.alias("s")).select(*by, "s.*").where("value is not null")
    counts = values.groupBy(*keys, "value").count()
    highest = counts.groupBy(*keys).agg(F.max("count").alias("count"))
    return counts.join(highest, [*keys, "count"]).groupBy(*keys).agg(F.min("value").alias("value"))


def append_mean_row(table: DataFrame, label: dict[str, object], metrics: list[str],
                    by: list[str] = ()) -> DataFrame:
    """Add the plain mean of the rows (not pooled); columns without a mean are null."""
    mean = table.groupBy(*by).agg(*[F.avg(c).alias(c) for c in metrics])
    for column, value in label.items():
        mean = mean.withColumn(column, F.lit(value))
    return table.unionByName(mean, allowMissingColumns=True)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value) for every distinct text of the columns."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    return df.select(cells.alias("s")).select("s.*").where("value is not null").distinct()
