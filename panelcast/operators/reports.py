"""Error reports: out-of-fold predictions in, one row per family, fold or model out.

Each report reads the predictions once for its sums (twice when it has a band around
the prediction); rows of coarser groups come from the sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import metrics as M
from panelcast.operators.aggregates import append_mean_row
from panelcast.operators.folds import Fold, assign_folds, folds_table
from panelcast.operators.joins import with_segment
from panelcast.session import materialize

# Labels of the summary rows.
OVERALL_LINEAR = "Overall (5 folds)"
OVERALL_BOOSTED = "all_folds"
OVERALL_FOREST = "Overall (5 Folds Average)"
OVERALL_CORE = "Overall (Nhóm A)"
OVERALL_HURDLE = "Overall (Nhóm B - Two-Part Model)"
AVERAGE_ARX = "AVERAGE (Trung bình nhóm)"


def _linear_metrics() -> list[Column]:
    return [
        M.mae().alias("MAE"), M.rmse().alias("RMSE"), M.mape("a").alias("MAPE"), M.r2("a").alias("R2"),
        M.accuracy("a", "a").alias("accuracy"), M.coverage().alias("coverage_95"),
        M.avg_width().alias("avg_width"), M.mean_sale().alias("mean_sale"), M.wape("a").alias("WAPE"),
    ]


METRICS_LINEAR = ["MAE", "RMSE", "MAPE", "R2", "accuracy", "coverage_95", "avg_width", "mean_sale", "WAPE"]


def _banded(oof: DataFrame, by: list[str], spread: Column) -> DataFrame:
    sums = materialize(M.error_sums(oof, by), "error_sums")
    return M.normal_band(oof, sums, by, spread)


def linear_family_report(oof: DataFrame) -> DataFrame:
    """Linear model by family; ``oof`` carries the segment."""
    sums = _banded(oof, ["family", "segment"], M.residual_std())
    return sums.select(F.col("family").alias("family_name"), *_linear_metrics(), "segment").orderBy("family_name")


def linear_fold_report(oof: DataFrame, segment: str = "High") -> DataFrame:
    """Linear model by fold for one segment, with the plain mean of the folds."""
    rows = oof.where(F.col("segment") == segment)
    sums = _banded(rows, ["fold"], M.residual_std())
    table = sums.select(F.col("fold").cast("string").alias("fold"), *_linear_metrics(),
                        F.lit(segment).alias("segment"))
    return append_mean_row(table, {"fold": OVERALL_LINEAR, "segment": segment}, METRICS_LINEAR)


def boosted_family_report(oof: DataFrame) -> DataFrame:
    """Boosted model by family, rounded to 6 digits, best R2 first."""
    scored = oof.na.drop(subset=["y_true", "y_pred", "family"])
    table = M.error_sums(scored, ["family"]).select(
        F.col("family").alias("family_name"),
        *[F.round(c, 6).alias(n) for n, c in (
            ("MAE", M.mae()), ("RMSE", M.rmse()), ("MAPE", M.mape("b")), ("R2", M.r2("c")),
            ("Accuracy (%)", M.accuracy("a", "b")))],
        F.col("n").alias("Count"),
    )
    return table.orderBy(F.desc_nulls_last("R2"), "family_name")


def fold_counts(panel: DataFrame, folds: list[Fold]) -> DataFrame:
    """Training and test rows per fold, from one count per day."""
    daily = panel.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    split = assign_folds(daily, folds)
    return split.groupBy("fold").agg(
        F.sum(F.when(F.col("split") == "train", F.col("n")).otherwise(0)).alias("n_train_rows"),
        F.sum(F.when(F.col("split") == "test", F.col("n")).otherwise(0)).alias("n_panel_test_rows"),
    )


def boosted_fold_report(oof: DataFrame, panel: DataFrame, folds: list[Fold]) -> DataFrame:
    """Boosted model by fold with bounds and row counts, and the pooled row."""
    sums = M.error_sums(oof, ["fold"])
    metrics = [M.rmse().alias("rmse"), M.mae().alias("mae"), M.mape("b").alias("mape"), M.r2("c").alias("r2")]
    bounds = folds_table(oof.sparkSession, folds).join(fold_counts(panel, folds), "fold")
    by_fold = sums.join(bounds, "fold").select(
        F.concat(F.lit("fold_"), F.col("fold").cast("string")).alias("fold"),
        "train_start", "train_end", "test_start", "test_end", "n_train_rows",
        F.col("n").alias("n_test_rows"), *metrics,
    )
    pooled = M.pool(sums, []).select(F.lit(OVERALL_BOOSTED).alias("fold"), F.col("n").alias("n_test_rows"), *metrics)
    return by_fold.unionByName(pooled, allowMissingColumns=True)


def _medium_metrics(segment: str) -> list[Column]:
    return [
        M.mae().alias("MAE"), M.rmse().alias("RMSE"), M.mape("c").alias("MAPE"), M.r2("c").alias("R2"),
        M.accuracy("b", "c").alias("accuracy"), M.coverage().alias("coverage_95"),
        M.avg_width().alias("avg_width"), M.mean_sale().alias("mean_sale"), M.wape("b").alias("WAPE"),
        F.lit(segment).alias("segment"), M.accuracy("e").alias("accuracy_20pct"),
    ]


def medium_family_report(oof: DataFrame, segment: str = "Medium") -> DataFrame:
    """Medium-segment model by family; the band is one RMSE wide times 1.96."""
    return _banded(oof, ["family"], M.rmse()).select(F.col("family").alias("family_name"), *_medium_metrics(segment))


def medium_fold_report(oof: DataFrame, segment: str = "Medium") -> DataFrame:
    """Medium-segment models by model and fold."""
    return _banded(oof, ["model", "fold"], M.rmse()).select("model", "fold", *_medium_metrics(segment))


def _forest_metrics() -> list[Column]:
    return [
        M.mae().alias("MAE"), M.rmse().alias("RMSE"), M.r2("c").alias("R2"), M.mape("f").alias("MAPE"),
        M.accuracy("a", "f").alias("Accuracy (%)"), F.col("n").alias("Count"),
    ]


def forest_complete_report(oof: DataFrame) -> DataFrame:
    """Families, folds and the pooled row in one table, from one pass by family and fold."""
    sums = M.error_sums(oof, ["family", "fold"])
    families = M.pool(sums, ["family"]).select(F.col("family").alias("family_name"), *_forest_metrics())
    folds = M.pool(sums, ["fold"]).select(
        F.concat(F.lit("Fold "), F.col("fold").cast("string")).alias("family_name"), *_forest_metrics()
    )
    pooled = M.pool(sums, []).select(F.lit(OVERALL_FOREST).alias("family_name"), *_forest_metrics())
    return families.unionByName(folds).unionByName(pooled)


def forest_part_report(oof: DataFrame, label: str, sort: str) -> DataFrame:
    """Families of one tier by a descending metric, and their pooled row last."""
    sums = M.error_sums(oof, ["family"])
    families = M.pool(sums, ["family"]).select(
        F.lit(0).alias("block"), F.col("family").alias("family_name"), *_forest_metrics())
    pooled = M.pool(sums, []).select(F.lit(1).alias("block"), F.lit(label).alias("family_name"), *_forest_metrics())
    return families.unionByName(pooled).orderBy("block", F.desc_nulls_last(f"`{sort}`"), "family_name").drop("block")


def arx_report(predictions: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Seasonal ARX by family with the mean row of each group, rounded to 4 digits.

    ``predictions`` has segment, family, y_true, y_pred; ``orders`` has the order text.
    """
    sums = M.error_sums(predictions, ["segment", "family"])
    table = sums.select(
        F.col("segment").alias("Group_Category"), "family", M.rmse().alias("RMSE"), M.mae().alias("MAE"),
        M.r2("c").alias("R2"), M.accuracy("f").alias("Accuracy_Pct"), M.wape("c").alias("WAPE"),
    )
    if orders is not None:
        table = table.join(orders.select("family", "Order", "Seasonal_Order"), "family", "left")
    label = {"family": AVERAGE_ARX} | ({"Order": "-", "Seasonal_Order": "-"} if orders is not None else {})
    table = append_mean_row(table, label, ["RMSE", "MAE", "R2", "Accuracy_Pct"], ["Group_Category"])
    return table.withColumns({c: F.round(c, 4) for c in ("RMSE", "MAE", "R2", "Accuracy_Pct", "WAPE")})


METRICS_ADDITIVE = ["MAE", "RMSE", "MAPE", "R2", "accuracy", "coverage_95", "avg_width", "mean_sales", "WAPE"]


def additive_report(predictions: DataFrame, mean_sales: DataFrame) -> DataFrame:
    """Additive model by family, the mean of each group, and the mean of all families.

    ``predictions`` has segment, family, y_true, y_pred, lower, upper; ``mean_sales``
    the mean of the raw rows per family.
    """
    sums = M.error_sums(predictions, ["segment", "family"], lower="lower", upper="upper")
    detail = sums.join(mean_sales.select("family", "mean_sales"), "family").select(
        F.col("family").alias("family_name"), M.mae().alias("MAE"), M.rmse().alias("RMSE"),
        M.mape("e").alias("MAPE"), M.r2("c").alias("R2"), M.accuracy("d").alias("accuracy"),
        M.coverage().alias("coverage_95"), M.avg_width().alias("avg_width"), "mean_sales",
        M.wape("c").alias("WAPE"), "segment",
    )
    means = [F.avg(c).alias(c) for c in METRICS_ADDITIVE]
    groups = detail.groupBy("segment").agg(*means).withColumn(
        "family_name", F.concat(F.lit("AVG_"), F.col("segment"))
    )
    grand = detail.agg(*means).withColumns({
        "segment": F.lit("ALL_GROUPS"), "family_name": F.lit(None).cast("string")
    })
    return detail.unionByName(groups).unionByName(grand)


def _quantile_metrics(r2: str) -> list[Column]:
    return [
        M.mae().alias("MAE"), M.rmse().alias("RMSE"), M.mape("d").alias("MAPE"), M.r2(r2).alias("R2"),
        M.accuracy("c").alias("accuracy"), M.coverage().alias("coverage_95"), M.avg_width().alias("avg_width"),
    ]


def quantile_fold_report(predictions: DataFrame, folds: list[Fold], segment: str = "ALL") -> DataFrame:
    """Quantile forecast by fold; a fold without predictions keeps a row of nulls."""
    sums = M.error_sums(predictions, ["fold"], yhat="q50", lower="q05", upper="q95")
    names = folds_table(predictions.sparkSession, folds).select("fold")
    return names.join(sums, "fold", "left").select("fold", F.lit(segment).alias("segment"), *_quantile_metrics("c"))


def quantile_family_report(predictions: DataFrame, segments: DataFrame) -> DataFrame:
    """Quantile forecast by family, smallest MAE first, with the segment."""
    sums = M.error_sums(predictions, ["family"], yhat="q50", lower="q05", upper="q95")
    table = with_segment(sums, segments).select(
        F.col("family").alias("family_name"), *_quantile_metrics("b"), M.mean_sale().alias("mean_sale"),
        M.wape("d").alias("WAPE"), "segment",
    )
    return table.orderBy("MAE", "family_name")
