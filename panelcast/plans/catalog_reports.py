"""Metric variants and error reports on stand-in predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import metrics as M
from panelcast.operators import aggregates as A
from panelcast.operators import joins, reports, windows
from panelcast.operators import series as S
from panelcast.plans.catalog_base import FILLED, round_all
from panelcast.plans.oracle import more, sql, sql_rounded
from panelcast.plans.panel import FOLDS, panel_table, sales_panel, segments, stand_in_predictions
from panelcast.plans.registry import query
from panelcast.session import materialize

# --- metric variants by family and fold --------------------------------------------------

ERR = "abs(y_true - y_pred)"
R2_SQL = "1 - sum((y_true - y_pred) ** 2) / nullif(var_pop(y_true) * count(*), 0)"
CONSTANT = "min(y_true) = max(y_true)"
PERFECT = "CASE WHEN count(*) < 2 THEN NULL WHEN sum((y_true - y_pred) ** 2) = 0 THEN 1.0 ELSE 0.0 END"
MAPE_A = f"100 * avg(CASE WHEN y_true <> 0 THEN {ERR} / abs(y_true) END)"
MAPE_B = f"100 * avg({ERR} / CASE WHEN y_true = 0 THEN 1 ELSE abs(y_true) END)"
MAPE_C = f"COALESCE(100 * avg(CASE WHEN y_true > 0 THEN {ERR} / y_true END), 0)"
MAPE_F = f"100 * avg(CASE WHEN y_true > 0 THEN {ERR} / y_true END)"
MAPE_D = f"100 * avg({ERR} / greatest(y_true, 1e-6))"
MAPE_E = f"avg({ERR} / greatest(abs(y_true), 2.220446049250313e-16))"

# id, column name, our metric, SQL, digits
VARIANTS: list[tuple[str, str, Callable[[], Column], str, int]] = [
    ("e1_mae", "MAE", lambda: M.mae(), f"avg({ERR})", 6),
    ("e2_rmse", "RMSE", lambda: M.rmse(), "sqrt(avg((y_true - y_pred) ** 2))", 6),
    ("e3a_mape_nonzero", "MAPE", lambda: M.mape("a"), MAPE_A, 6),
    ("e3b_mape_one", "MAPE", lambda: M.mape("b"), MAPE_B, 6),
    ("e3c_mape_positive", "MAPE", lambda: M.mape("c"), MAPE_C, 6),
    ("e3d_mape_floor", "MAPE", lambda: M.mape("d"), MAPE_D, 0),
    ("e3e_mape_eps", "MAPE", lambda: M.mape("e"), MAPE_E, -6),
    ("e3f_mape_positive_null", "MAPE", lambda: M.mape("f"), MAPE_F, 6),
    ("e4a_wape_abs", "WAPE", lambda: M.wape("a"), f"sum({ERR}) / nullif(sum(abs(y_true)), 0)", 6),
    ("e4b_wape_sum", "WAPE", lambda: M.wape("b"), f"COALESCE(sum({ERR}) / nullif(sum(y_true), 0), 0)", 6),
    ("e4c_wape_mean", "WAPE", lambda: M.wape("c"), f"COALESCE(avg({ERR}) / nullif(avg(y_true), 0), 0)", 6),
    ("e4d_wape_positive", "WAPE", lambda: M.wape("d"), f"CASE WHEN avg(y_true) > 0 THEN avg({ERR}) / avg(y_true) END", 6),
    ("e5a_r2_zero", "R2", lambda: M.r2("a"), f"CASE WHEN {CONSTANT} THEN 0 ELSE {R2_SQL} END", 6),
    ("e5b_r2_null", "R2", lambda: M.r2("b"), f"CASE WHEN {CONSTANT} THEN NULL ELSE {R2_SQL} END", 6),
    ("e5c_r2_library", "R2", lambda: M.r2("c"), f"CASE WHEN {CONSTANT} THEN {PERFECT} ELSE {R2_SQL} END", 6),
    ("e6a_accuracy", "accuracy", lambda: M.accuracy("a", "a"), f"100 - {MAPE_A}", 6),
    ("e6b_accuracy_floor", "accuracy", lambda: M.accuracy("b", "c"), f"greatest(0, 100 - {MAPE_C})", 6),
    ("e6c_accuracy_within", "accuracy", lambda: M.accuracy("c"),
     f"100 * avg(CASE WHEN {ERR} <= 0.2 * greatest(y_true, 1e-6) THEN 1.0 ELSE 0.0 END)", 6),
    ("e6d_accuracy_within_abs", "accuracy", lambda: M.accuracy("d"),
     f"100 * avg(CASE WHEN {ERR} <= 0.2 * abs(y_true) THEN 1.0 ELSE 0.0 END)", 6),
    ("e6e_accuracy_20pct", "accuracy_20pct", lambda: M.accuracy("e"),
     f"100 * avg(CASE WHEN y_true = 0 THEN CASE WHEN y_pred = 0 THEN 1.0 ELSE 0.0 END "
     f"WHEN {ERR} / y_true <= 0.2 THEN 1.0 ELSE 0.0 END)", 6),
    ("e6f_accuracy_pct", "Accuracy_Pct", lambda: M.accuracy("f"),
     f"CASE WHEN sum(abs(y_true)) = 0 THEN CASE WHEN sum({ERR}) = 0 THEN 100.0 ELSE 0.0 END "
     f"ELSE 100 * (1 - sum({ERR}) / nullif(sum(abs(y_true)), 0)) END", 6),
    ("e8_mean_sale", "mean_sale", lambda: M.mean_sale(), "avg(y_true)", 6),
    ("e9_count", "Count", lambda: F.col("n"), "count(*)", 0),
]


def _register(name: str, column: str, metric: Callable[[], Column], expression: str, digits: int) -> None:
    text = sql(f"SELECT family, fold, round({expression}, {digits}) AS \"{column}\" FROM oof GROUP BY family, fold")

    def run(spark, sf):
        sums = M.error_sums(stand_in_predictions(spark, sf), ["family", "fold"])
        return sums.select("family", "fold", F.round(metric(), digits).alias(column))

    query(name, text)(run)


for _variant in VARIANTS:
    _register(*_variant)


def _band_sql(spread: str, by: str, source: str = "oof") -> str:
    return f"""
SELECT {by}, 100 * avg(CASE WHEN y_true >= y_pred - 1.96 * s AND y_true <= y_pred + 1.96 * s THEN 1.0 ELSE 0.0 END) AS coverage_95,
       avg(2 * 1.96 * s) AS avg_width
FROM (SELECT *, {spread} AS s FROM {source}) GROUP BY {by}"""


RESID_STD = "COALESCE(stddev_samp(y_true - y_pred) OVER (PARTITION BY {by}), 0)"
RMSE_WINDOW = "sqrt(avg((y_true - y_pred) ** 2) OVER (PARTITION BY {by}))"


@query("e7a_band_resid_std", sql_rounded(_band_sql(RESID_STD.format(by="family, fold"), "family, fold"), ["coverage_95", "avg_width"]))
def _(spark, sf):
    oof = materialize(stand_in_predictions(spark, sf), "oof")
    sums = materialize(M.error_sums(oof, ["family", "fold"]), "error_sums")
    banded = M.normal_band(oof, sums, ["family", "fold"], M.residual_std())
    return round_all(banded.select("family", "fold", M.coverage().alias("coverage_95"), M.avg_width().alias("avg_width")))


@query("e7b_band_rmse", sql_rounded(_band_sql(RMSE_WINDOW.format(by="family, fold"), "family, fold"), ["coverage_95", "avg_width"]))
def _(spark, sf):
    oof = materialize(stand_in_predictions(spark, sf), "oof")
    sums = materialize(M.error_sums(oof, ["family", "fold"]), "error_sums")
    banded = M.normal_band(oof, sums, ["family", "fold"], M.rmse())
    return round_all(banded.select("family", "fold", M.coverage().alias("coverage_95"), M.avg_width().alias("avg_width")))


# Stand-in quantiles: the 30-row mean, and a quarter and the double of it.
QUANTILES = """
q AS (SELECT *, y_pred_mean * 0.25 AS q05, y_pred_mean AS q50, y_pred_mean * 2.0 AS q95 FROM oof)"""


def stand_in_quantiles(spark, sf, panel: DataFrame | None = None) -> DataFrame:
    mean = F.col("y_pred_mean")
    return stand_in_predictions(spark, sf, panel).withColumns({"q05": mean * 0.25, "q50": mean, "q95": mean * 2.0})


COVERED = "100 * avg(CASE WHEN y_true >= {lo} AND y_true <= {hi} THEN 1.0 ELSE 0.0 END) AS coverage_95, avg({hi} - {lo}) AS avg_width"


@query("e7c_band_quantiles", sql_rounded(
    "SELECT family, fold, " + COVERED.format(lo="q05", hi="q95") + " FROM q GROUP BY family, fold",
    ["coverage_95", "avg_width"], ctes=QUANTILES))
def _(spark, sf):
    sums = M.error_sums(stand_in_quantiles(spark, sf), ["family", "fold"], yhat="q50", lower="q05", upper="q95")
    return round_all(sums.select("family", "fold", M.coverage().alias("coverage_95"), M.avg_width().alias("avg_width")))


# Stand-in daily forecasts: the value seven days back, with a band of 20 either side.
DAILY_OOF = FILLED + """,
dp AS (SELECT * FROM (
         SELECT seg.segment, daily.family, daily.date, daily.sales AS y_true,
                lag(daily.sales, 7) OVER (PARTITION BY daily.family ORDER BY daily.date) AS y_pred,
                row_number() OVER (PARTITION BY daily.family ORDER BY daily.date DESC) AS r
         FROM daily JOIN seg ON daily.family = seg.family) WHERE r <= 90),
db AS (SELECT *, y_pred - 20 AS lower, y_pred + 20 AS upper FROM dp)"""


def stand_in_daily(spark, sf, panel: DataFrame | None = None) -> DataFrame:
    if panel is None:
        panel = panel_table(spark, sf, oil=True)
    daily = windows.series_select(S.daily_series(panel), windows.add_lags([7]), keys=["family"])
    test = windows.holdout_last(daily, 90, ["family"]).where("is_test")
    scored = test.select("family", "date", F.col("sales").alias("y_true"), F.col("sales_lag_7").alias("y_pred"),
                         (F.col("sales_lag_7") - 20).alias("lower"), (F.col("sales_lag_7") + 20).alias("upper"))
    return joins.with_segment(scored, segments(spark, sf, panel), how="inner")


@query("e7d_band_model", sql_rounded(
    "SELECT family, " + COVERED.format(lo="lower", hi="upper") + " FROM db GROUP BY family",
    ["coverage_95", "avg_width"], ctes=DAILY_OOF))
def _(spark, sf):
    sums = M.error_sums(stand_in_daily(spark, sf), ["family"], lower="lower", upper="upper")
    return round_all(sums.select("family", M.coverage().alias("coverage_95"), M.avg_width().alias("avg_width")))


@query("e10_pinball", sql_rounded(
    "SELECT family, " + ", ".join(
        f"avg(greatest({t} * (y_true - {c}), ({t} - 1) * (y_true - {c}))) AS loss_{c}"
        for c, t in (("q05", 0.05), ("q50", 0.5), ("q95", 0.95))) + " FROM q GROUP BY family",
    ["loss_q05", "loss_q50", "loss_q95"], ctes=QUANTILES))
def _(spark, sf):
    rows = stand_in_quantiles(spark, sf)
    return round_all(rows.groupBy("family").agg(*[
        F.avg(M.pinball("y_true", c, t)).alias(f"loss_{c}") for c, t in (("q05", 0.05), ("q50", 0.5), ("q95", 0.95))
    ]))


# --- reports -----------------------------------------------------------------------------


def _tagged(spark, sf, names: list[str] | None = None) -> DataFrame:
    panel = panel_table(spark, sf)
    oof, seg = stand_in_predictions(spark, sf, panel), segments(spark, sf, panel)
    if names is not None:
        seg = seg.where(F.col("segment").isin(names))
    return materialize(joins.with_segment(oof, seg, how="inner"), "oof")


LINEAR_COLS = ["MAE", "RMSE", "MAPE", "R2", "accuracy", "coverage_95", "avg_width", "mean_sale", "WAPE"]
R2_A = f"CASE WHEN {CONSTANT} THEN 0 ELSE {R2_SQL} END AS R2"
R2_C = f"CASE WHEN {CONSTANT} THEN {PERFECT} ELSE {R2_SQL} END"


def _linear_sql(by: str) -> str:
    band = (f"100 * avg(CASE WHEN y_true >= y_pred - 1.96 * s AND y_true <= y_pred + 1.96 * s THEN 1.0 ELSE 0.0 END)"
            f" AS coverage_95, avg(2 * 1.96 * s) AS avg_width")
    return f"""avg({ERR}) AS MAE, sqrt(avg((y_true - y_pred) ** 2)) AS RMSE, {MAPE_A} AS MAPE, {R2_A},
       100 - {MAPE_A} AS accuracy, {band}, avg(y_true) AS mean_sale, sum({ERR}) / nullif(sum(abs(y_true)), 0) AS WAPE
FROM (SELECT *, {RESID_STD.format(by=by)} AS s FROM oof"""


@query("r1_linear_family_report", sql_rounded(
    f"SELECT family AS family_name, {_linear_sql('family')} WHERE segment IN ('High', 'Medium')) GROUP BY family, segment"
    .replace("SELECT family AS family_name,", "SELECT family AS family_name, segment,"), LINEAR_COLS))
def _(spark, sf):
    return round_all(reports.linear_family_report(_tagged(spark, sf, ["High", "Medium"])))


R2_FOLDS = f"lf AS (SELECT CAST(fold AS VARCHAR) AS fold, {_linear_sql('fold')} WHERE segment = 'High') GROUP BY fold)"


@query("r2_linear_fold_report", sql_rounded(
    "SELECT *, 'High' AS segment FROM lf UNION ALL SELECT 'Overall (5 folds)', "
    + ", ".join(f"avg({c})" for c in LINEAR_COLS) + ", 'High' FROM lf", LINEAR_COLS, ctes=R2_FOLDS))
def _(spark, sf):
    return round_all(reports.linear_fold_report(_tagged(spark, sf, ["High", "Medium"])))


@query("r3_boosted_family_report", sql_rounded(f"""
SELECT family AS family_name, avg({ERR}) AS MAE, sqrt(avg((y_true - y_pred) ** 2)) AS RMSE, {MAPE_B} AS MAPE,
       {R2_C} AS R2, 100 - {MAPE_B} AS "Accuracy (%)", count(*) AS "Count" FROM oof GROUP BY family""",
                                               ["MAE", "RMSE", "MAPE", "R2", "Accuracy (%)"]))
def _(spark, sf):
    return reports.boosted_family_report(stand_in_predictions(spark, sf))


FOLD_METRICS = (f"count(*) AS n_test_rows, sqrt(avg((y_true - y_pred) ** 2)) AS rmse, avg({ERR}) AS mae, "
                f"{MAPE_B} AS mape, {R2_C} AS r2")


@query("r4_boosted_fold_report", sql_rounded(f"""
SELECT 'fold_' || f.fold AS fold, f.train_start, f.train_end, f.test_start, f.test_end,
       (SELECT count(*) FROM panel p WHERE p.date BETWEEN f.train_start AND f.train_end) AS n_train_rows, m.* EXCLUDE (fold)
FROM folds f JOIN (SELECT fold, {FOLD_METRICS} FROM oof GROUP BY fold) m ON f.fold = m.fold
UNION ALL
SELECT 'all_folds', NULL, NULL, NULL, NULL, NULL, {FOLD_METRICS} FROM oof""", ["rmse", "mae", "mape", "r2"]))
def _(spark, sf):
    panel = panel_table(spark, sf)
    return round_all(reports.boosted_fold_report(stand_in_predictions(spark, sf, panel), panel, FOLDS))


@query("a20_fold_summary", sql("""
SELECT f.fold, (SELECT count(*) FROM panel p WHERE p.date BETWEEN f.train_start AND f.train_end) AS n_train_rows,
       (SELECT count(*) FROM panel p WHERE p.date BETWEEN f.test_start AND f.test_end) AS n_panel_test_rows FROM folds f"""))
def _(spark, sf):
    return reports.fold_counts(sales_panel(spark, sf, oil=False), FOLDS)


@query("a21_mean_row", sql_rounded(f"""
SELECT family, m FROM (SELECT family, avg({ERR}) AS m FROM oof GROUP BY family)
UNION ALL SELECT 'AVERAGE', avg(m) FROM (SELECT avg({ERR}) AS m FROM oof GROUP BY family)""", ["m"]))
def _(spark, sf):
    table = M.error_sums(stand_in_predictions(spark, sf), ["family"]).select("family", M.mae().alias("m"))
    return round_all(A.append_mean_row(table, {"family": "AVERAGE"}, ["m"]))


@query("a22_pooled_row", sql_rounded(f"""
SELECT CASE WHEN grouping(fold) = 1 THEN 'all' ELSE CAST(fold AS VARCHAR) END AS fold, avg({ERR}) AS MAE,
       {R2_C} AS R2 FROM oof GROUP BY GROUPING SETS ((fold), ())""", ["MAE", "R2"]))
def _(spark, sf):
    sums = M.error_sums(stand_in_predictions(spark, sf), ["fold"])
    rows = sums.withColumn("fold", F.col("fold").cast("string"))
    pooled = M.pool(sums, []).withColumn("fold", F.lit("all"))
    return round_all(rows.unionByName(pooled).select("fold", M.mae().alias("MAE"), M.r2("c").alias("R2")))


MEDIUM_COLS = ["MAE", "RMSE", "MAPE", "R2", "accuracy", "coverage_95", "avg_width", "mean_sale", "WAPE", "accuracy_20pct"]


def _medium_sql(by: str, source: str) -> str:
    return f"""avg({ERR}) AS MAE, sqrt(avg((y_true - y_pred) ** 2)) AS RMSE, {MAPE_C} AS MAPE, {R2_C} AS R2,
       greatest(0, 100 - {MAPE_C}) AS accuracy,
       100 * avg(CASE WHEN y_true >= y_pred - 1.96 * s AND y_true <= y_pred + 1.96 * s THEN 1.0 ELSE 0.0 END) AS coverage_95,
       avg(2 * 1.96 * s) AS avg_width, avg(y_true) AS mean_sale, COALESCE(sum({ERR}) / nullif(sum(y_true), 0), 0) AS WAPE,
       'Medium' AS segment,
       100 * avg(CASE WHEN y_true = 0 THEN CASE WHEN y_pred = 0 THEN 1.0 ELSE 0.0 END
                      WHEN {ERR} / y_true <= 0.2 THEN 1.0 ELSE 0.0 END) AS accuracy_20pct
FROM (SELECT *, {RMSE_WINDOW.format(by=by)} AS s FROM {source}) GROUP BY {by}"""


@query("r5_medium_family_report", sql_rounded(
    "SELECT family AS family_name, " + _medium_sql("family", "(SELECT * FROM oof WHERE segment = 'Medium')"), MEDIUM_COLS))
def _(spark, sf):
    return round_all(reports.medium_family_report(_tagged(spark, sf, ["Medium"])))


TWO_MODELS = """
two AS (SELECT 'lag' AS model, fold, y_true, y_pred FROM oof WHERE segment = 'Medium'
        UNION ALL SELECT 'mean', fold, y_true, y_pred_mean FROM oof WHERE segment = 'Medium')"""


@query("r6_medium_fold_report", sql_rounded(
    "SELECT model, fold, " + _medium_sql("model, fold", "two"), MEDIUM_COLS, ctes=TWO_MODELS))
def _(spark, sf):
    oof = _tagged(spark, sf, ["Medium"])
    lag = oof.select(F.lit("lag").alias("model"), "fold", "y_true", "y_pred")
    mean = oof.select(F.lit("mean").alias("model"), "fold", "y_true", F.col("y_pred_mean").alias("y_pred"))
    return round_all(reports.medium_fold_report(lag.unionByName(mean)))


FOREST_COLS = ["MAE", "RMSE", "R2", "MAPE", "Accuracy (%)"]
FOREST_SQL = (f"avg({ERR}) AS MAE, sqrt(avg((y_true - y_pred) ** 2)) AS RMSE, {R2_C} AS R2, {MAPE_F} AS MAPE, "
              f"100 - {MAPE_F} AS \"Accuracy (%)\", count(*) AS \"Count\"")


@query("r7_forest_complete_report", sql_rounded(f"""
SELECT family AS family_name, {FOREST_SQL} FROM oof GROUP BY family
UNION ALL SELECT 'Fold ' || fold, {FOREST_SQL} FROM oof GROUP BY fold
UNION ALL SELECT 'Overall (5 Folds Average)', {FOREST_SQL} FROM oof""", FOREST_COLS))
def _(spark, sf):
    return round_all(reports.forest_complete_report(stand_in_predictions(spark, sf)))


def _part_sql(where: str, label: str) -> str:
    return sql_rounded(f"""
SELECT family AS family_name, {FOREST_SQL} FROM oof WHERE {where} GROUP BY family
UNION ALL SELECT '{label}', {FOREST_SQL} FROM oof WHERE {where}""", FOREST_COLS)


@query("r8_forest_core_report", _part_sql("segment = 'High'", "Overall (Nhóm A)"))
def _(spark, sf):
    return round_all(reports.forest_part_report(
        _tagged(spark, sf, ["High"]), reports.OVERALL_CORE, "Accuracy (%)"))


@query("r9_forest_hurdle_report", _part_sql("segment <> 'High'", "Overall (Nhóm B - Two-Part Model)"))
def _(spark, sf):
    return round_all(reports.forest_part_report(
        _tagged(spark, sf, ["Medium", "Low", "Ultra-low"]), reports.OVERALL_HURDLE, "R2"))


ARX_COLS = ["RMSE", "MAE", "R2", "Accuracy_Pct", "WAPE"]
ARX_ROWS = DAILY_OOF + f""",
ar AS (SELECT segment AS Group_Category, family, sqrt(avg((y_true - y_pred) ** 2)) AS RMSE, avg({ERR}) AS MAE, {R2_C} AS R2,
              CASE WHEN sum(abs(y_true)) = 0 THEN CASE WHEN sum({ERR}) = 0 THEN 100.0 ELSE 0.0 END
                   ELSE 100 * (1 - sum({ERR}) / nullif(sum(abs(y_true)), 0)) END AS Accuracy_Pct,
              COALESCE(avg({ERR}) / nullif(avg(y_true), 0), 0) AS WAPE
       FROM dp GROUP BY segment, family)"""


@query("r10_arx_report", sql_rounded("""
SELECT * FROM ar UNION ALL
SELECT Group_Category, 'AVERAGE (Trung bình nhóm)', avg(RMSE), avg(MAE), avg(R2), avg(Accuracy_Pct), NULL
FROM ar GROUP BY Group_Category""", ARX_COLS, 4, ctes=ARX_ROWS))
def _(spark, sf):
    return reports.arx_report(stand_in_daily(spark, sf))


ADDITIVE_ROWS = DAILY_OOF + f""",
ad AS (SELECT db.family AS family_name, avg({ERR}) AS MAE, sqrt(avg((y_true - y_pred) ** 2)) AS RMSE, {MAPE_E} AS MAPE, {R2_C} AS R2,
              100 * avg(CASE WHEN {ERR} <= 0.2 * abs(y_true) THEN 1.0 ELSE 0.0 END) AS accuracy,
              {COVERED.format(lo="lower", hi="upper")}, any_value(ms.mean_sales) AS mean_sales,
              COALESCE(avg({ERR}) / nullif(avg(y_true), 0), 0) AS WAPE, segment
       FROM db JOIN (SELECT family, avg(sales) AS mean_sales FROM panel GROUP BY family) ms ON db.family = ms.family
       GROUP BY db.family, segment)"""
ADDITIVE_MEANS = ", ".join(f"avg({c})" for c in reports.METRICS_ADDITIVE)


def _additive_digits(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, -6 if c == "MAPE" else 6) for c in reports.METRICS_ADDITIVE})


@query("r11_additive_report", more(ADDITIVE_ROWS, "SELECT family_name, segment, " + ", ".join(
    f"round({c}, {-6 if c == 'MAPE' else 6}) AS {c}" for c in reports.METRICS_ADDITIVE) + f"""
FROM (SELECT * FROM ad UNION ALL SELECT 'AVG_' || segment, {ADDITIVE_MEANS}, segment FROM ad GROUP BY segment
      UNION ALL SELECT NULL, {ADDITIVE_MEANS}, 'ALL_GROUPS' FROM ad)"""))
def _(spark, sf):
    panel = panel_table(spark, sf, oil=True)
    means = panel.groupBy("family").agg(F.avg("sales").alias("mean_sales"))
    return _additive_digits(reports.additive_report(stand_in_daily(spark, sf, panel), means))


def _quantile_sql(r2: str) -> str:
    e = "abs(y_true - q50)"
    return f"""avg({e}) AS MAE, sqrt(avg((y_true - q50) ** 2)) AS RMSE,
       round(100 * avg({e} / greatest(y_true, 1e-6)), 0) AS MAPE, {r2.replace('y_pred', 'q50')} AS R2,
       100 * avg(CASE WHEN {e} <= 0.2 * greatest(y_true, 1e-6) THEN 1.0 ELSE 0.0 END) AS accuracy,
       {COVERED.format(lo="q05", hi="q95")}"""


QUANTILE_COLS = ["MAE", "RMSE", "R2", "accuracy", "coverage_95", "avg_width"]


@query("r12_quantile_fold_report", sql_rounded(f"""
SELECT folds.fold, 'ALL' AS segment, m.* EXCLUDE (fold) FROM folds LEFT JOIN (
  SELECT fold, {_quantile_sql(R2_C)} FROM q WHERE fold <> 5 GROUP BY fold) m ON folds.fold = m.fold""",
                                               QUANTILE_COLS, ctes=QUANTILES))
def _(spark, sf):
    # The last fold has no predictions here, so its row is empty.
    table = reports.quantile_fold_report(stand_in_quantiles(spark, sf).where("fold <> 5"), FOLDS)
    return round_all(table.withColumn("MAPE", F.round("MAPE", 0)))


@query("r12_quantile_fold_report_all_folds", sql_rounded(f"""
SELECT folds.fold, 'ALL' AS segment, m.* EXCLUDE (fold) FROM folds LEFT JOIN (
  SELECT fold, {_quantile_sql(R2_C)} FROM q GROUP BY fold) m ON folds.fold = m.fold""",
                                                         QUANTILE_COLS, ctes=QUANTILES))
def _(spark, sf):
    table = reports.quantile_fold_report(stand_in_quantiles(spark, sf), FOLDS)
    return round_all(table.withColumn("MAPE", F.round("MAPE", 0)))


@query("r13_quantile_family_report", sql_rounded(f"""
SELECT family AS family_name, {_quantile_sql(f"CASE WHEN {CONSTANT} THEN NULL ELSE {R2_SQL} END")}, avg(y_true) AS mean_sale,
       CASE WHEN avg(y_true) > 0 THEN avg(abs(y_true - q50)) / avg(y_true) END AS WAPE, segment
FROM q GROUP BY family, segment""", [*QUANTILE_COLS, "mean_sale", "WAPE"], ctes=QUANTILES))
def _(spark, sf):
    panel = panel_table(spark, sf)
    table = reports.quantile_family_report(stand_in_quantiles(spark, sf, panel), segments(spark, sf, panel))
    return round_all(table.withColumn("MAPE", F.round("MAPE", 0)))


# --- model comparison --------------------------------------------------------------------


def _performance(spark, sf) -> DataFrame:
    """Family tables of two stand-in models, one with fewer columns than the other."""
    panel = panel_table(spark, sf)
    oof = joins.with_segment(stand_in_predictions(spark, sf, panel), segments(spark, sf, panel), how="inner")
    oof = materialize(oof, "oof")
    by = ["family", "segment"]
    lag = M.error_sums(oof, by).select("segment", F.lit("lag").alias("model"), M.mae().alias("MAE"),
                                       M.rmse().alias("RMSE"), M.wape("a").alias("WAPE"))
    mean = M.error_sums(oof, by, yhat="y_pred_mean").select("segment", F.lit("mean").alias("model"),
                                                            M.mae().alias("MAE"), M.wape("a").alias("WAPE"))
    return lag.unionByName(mean, allowMissingColumns=True)


PERF = f"""
perf AS (SELECT segment, 'lag' AS model, avg({ERR}) AS MAE, sqrt(avg((y_true - y_pred) ** 2)) AS RMSE,
                sum({ERR}) / nullif(sum(abs(y_true)), 0) AS WAPE FROM oof GROUP BY family, segment
         UNION ALL
         SELECT segment, 'mean', avg(abs(y_true - y_pred_mean)), NULL,
                sum(abs(y_true - y_pred_mean)) / nullif(sum(abs(y_true)), 0) FROM oof GROUP BY family, segment)"""
PERF_MEANS = "avg(WAPE) AS WAPE, avg(MAE) AS MAE, avg(RMSE) AS RMSE"


@query("a14_compare_models", sql_rounded(f"SELECT model, {PERF_MEANS} FROM perf GROUP BY model ORDER BY WAPE",
                                         ["WAPE", "MAE", "RMSE"], ctes=PERF))
def _(spark, sf):
    return round_all(A.compare_models(_performance(spark, sf)).orderBy("WAPE", "model"))


@query("a15_compare_models_by_segment", sql_rounded(
    f"SELECT segment, model, {PERF_MEANS} FROM perf WHERE segment IN ('High', 'Medium', 'Low') GROUP BY segment, model",
    ["WAPE", "MAE", "RMSE"], ctes=PERF))
def _(spark, sf):
    return round_all(A.compare_models_by_segment(_performance(spark, sf)).orderBy("segment", "WAPE", "model"))


@query("r15_model_comparison", sql_rounded(f"""
SELECT 'overall' AS scope, model, {PERF_MEANS} FROM perf GROUP BY model
UNION ALL SELECT segment, model, {PERF_MEANS} FROM perf WHERE segment IN ('High', 'Medium', 'Low') GROUP BY segment, model""",
                                           ["WAPE", "MAE", "RMSE"], ctes=PERF))
def _(spark, sf):
    perf = materialize(_performance(spark, sf), "performance")
    overall = A.compare_models(perf).withColumn("scope", F.lit("overall"))
    parts = A.compare_models_by_segment(perf).withColumnRenamed("segment", "scope")
    return round_all(overall.unionByName(parts).orderBy("scope", "WAPE", "model"))
