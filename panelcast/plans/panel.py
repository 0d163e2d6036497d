"""Sales panel, segments and folds derived from the order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.features import calendar_features
from panelcast.operators.folds import assign_test_fold
from panelcast.operators.ranking import rank_small
from panelcast.operators.windows import add_lags, add_rolling, series_select
from panelcast.session import materialize

# The five expanding folds of the panel (train from 1997).
FOLDS = [
    (1, "1997-01-01", "1999-12-31", "2000-01-01", "2000-03-31"),
    (2, "1997-01-01", "2000-03-31", "2000-04-01", "2000-06-30"),
    (3, "1997-01-01", "2000-06-30", "2000-07-01", "2000-09-30"),
    (4, "1997-01-01", "2000-09-30", "2000-10-01", "2000-12-31"),
    (5, "1997-01-01", "2000-12-31", "2001-01-01", "2001-03-31"),
]
WHAT_IF_MONTH = ("2001-01-01", "2001-01-31")
YEAR_WEIGHTS = {1999: 1.5}
SERIES = ["store_nbr", "family"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_panel(
    spark: SparkSession, sf_dir: str, transactions: bool = False, oil: bool = True
) -> DataFrame:
    """One row per (date, store_nbr, family).

    The order lines are joined to the supplier and part keys (a hot key is split by
    the adaptive skew join) and collapse map-side to the panel key. ``transactions``
    and ``oil`` add one more pass each, so they are joined only when asked for.
    """
    lines = table(spark, sf_dir, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    stores = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        (F.col("s_nationkey") % 8).cast("int").alias("store_nbr"),
    )
    families = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("family")
    )
    sold = F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).otherwise(0.0)
    promoted = F.when(F.col("l_discount") >= 0.08, 1).otherwise(0)
    panel = (
        lines.join(stores, "l_suppkey")
        .join(families, "l_partkey")
        .groupBy("date", "store_nbr", "family")
        .agg(
            F.sum(sold).alias("sales"),
            F.sum(promoted).cast("int").alias("onpromotion"),
        )
    )
    if transactions:
        receipts = (
            lines.join(stores, "l_suppkey")
            .groupBy("date", "store_nbr")
            .agg(F.count_distinct("l_orderkey").cast("double").alias("transactions"))
        )
        panel = panel.join(receipts, ["date", "store_nbr"])
    panel = (
        panel.withColumn("city", F.concat(F.lit("city_"), F.col("store_nbr").cast("string")))
        .withColumn("state", F.concat(F.lit("state_"), (F.col("store_nbr") % 3).cast("string")))
        .withColumn("type", F.concat(F.lit("type_"), (F.col("store_nbr") % 5).cast("string")))
        .withColumn("cluster", (F.col("store_nbr") % 4).cast("int"))
    )
    if oil:
        prices = (
            table(spark, sf_dir, "orders")
            .groupBy(F.to_date("o_orderdate").alias("date"))
            .agg((F.max("o_totalprice") / 1000).alias("oil"))
        )
        panel = (
            panel.join(prices, "date", "left")
            .withColumn("dcoilwtico", F.when(F.weekday("date") < 5, F.col("oil")))
            .drop("oil")
        )
    panel = panel.withColumn("is_holiday", F.when(F.dayofmonth("date") == 1, 1).otherwise(0))
    return calendar_features(panel)


def panel_table(spark: SparkSession, sf_dir: str, transactions: bool = False, oil: bool = False) -> DataFrame:
    """The panel written once, for queries that read it more than once."""
    return materialize(sales_panel(spark, sf_dir, transactions, oil), "panel")


def segments(spark: SparkSession, sf_dir: str, panel: DataFrame | None = None) -> DataFrame:
    """family -> segment by rank of total sales; one row per family."""
    if panel is None:
        panel = sales_panel(spark, sf_dir, oil=False)
    totals = panel.groupBy("family").agg(F.sum("sales").alias("total"))
    ranked = rank_small(totals, [F.desc("total"), F.asc("family")], "rank")
    segment = (
        F.when(F.col("rank") <= 2, "High")
        .when(F.col("rank") <= 4, "Medium")
        .when(F.col("rank") == 5, "Low")
        .otherwise("Ultra-low")
    )
    return materialize(ranked.select("family", segment.alias("segment")), "segments")


def feature_panel(spark: SparkSession, sf_dir: str, transactions: bool = False) -> DataFrame:
    """Panel with lags and rolling statistics of the series; one shuffle by series."""
    return series_select(
        sales_panel(spark, sf_dir, transactions=transactions),
        [
            *add_lags([7, 14, 30]),
            *add_rolling([7, 30], "mean"),
            *add_rolling([7, 30], "std"),
        ],
    )


def stand_in_predictions(spark: SparkSession, sf_dir: str, panel: DataFrame | None = None) -> DataFrame:
    """Out-of-fold rows scored by the value seven rows back and by the 30-row mean."""
    if panel is None:
        panel = sales_panel(spark, sf_dir, oil=False)
    scored = series_select(panel, [*add_lags([7]), *add_rolling([30], "mean")])
    oof = assign_test_fold(scored, FOLDS).where(
        F.col("sales_lag_7").isNotNull() & F.col("rolling_mean_30").isNotNull()
    )
    return oof.select(
        "date",
        "store_nbr",
        "family",
        "fold",
        F.col("sales").alias("y_true"),
        F.col("sales_lag_7").alias("y_pred"),
        on_grid("rolling_mean_30").alias("y_pred_mean"),
    )


def on_grid(c: str) -> Column:
    """Value cut to eighths: sums of such errors are exact, so they are the same in any order."""
    return F.floor(F.col(c) * 8) / 8.0
