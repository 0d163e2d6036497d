"""Linear, Lasso, what-if, quantile and attribution queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators import aggregates as A
from panelcast.operators import attribution, features, folds, joins, linear, promo, ranking, reports, windows
from panelcast.plans.catalog_base import KEY, round_all
from panelcast.plans.oracle import more, sql_rounded
from panelcast.plans.panel import FOLDS, WHAT_IF_MONTH, panel_table, sales_panel, segments
from panelcast.plans.registry import query
from panelcast.session import materialize

PROMO = ["onpromotion", "promo_weekend", "promo_holiday"]


def promo_features(spark, sf) -> DataFrame:
    """Features with the promotion interactions, written once for the passes over it."""
    panel = windows.series_select(
        sales_panel(spark, sf, transactions=True),
        [*windows.add_lags([7, 14]), *windows.add_rolling([30], "mean")],
    )
    return materialize(features.add_promo_interactions(panel), "promo_features")


def promo_panel(spark, sf) -> DataFrame:
    """Panel with the promotion interactions, written once."""
    return materialize(features.add_promo_interactions(sales_panel(spark, sf, oil=False)), "promo_panel")


NULLABLE = ["dcoilwtico", "sales_lag_7", "sales_lag_14", "rolling_mean_30"]

# Three-feature least squares by Cramer's rule, over rows of pe grouped by family.
PE = "pe AS (SELECT *, onpromotion * is_weekend AS promo_weekend, onpromotion * is_holiday AS promo_holiday FROM panel)"


def cramer(name: str, where: str) -> str:
    return f"""
{name}_m AS (SELECT family, count(*) AS n, avg(sales) AS my,
   avg(onpromotion) AS m1, avg(promo_weekend) AS m2, avg(promo_holiday) AS m3,
   var_pop(onpromotion) AS a, covar_pop(onpromotion, promo_weekend) AS b, covar_pop(onpromotion, promo_holiday) AS c,
   var_pop(promo_weekend) AS d, covar_pop(promo_weekend, promo_holiday) AS e, var_pop(promo_holiday) AS f,
   covar_pop(sales, onpromotion) AS u, covar_pop(sales, promo_weekend) AS v, covar_pop(sales, promo_holiday) AS w
   FROM pe WHERE {where} GROUP BY family),
{name} AS (SELECT *, my - b1 * m1 - b2 * m2 - b3 * m3 AS b0 FROM (
   SELECT *, (u*(d*f-e*e) - b*(v*f-e*w) + c*(v*e-d*w)) / det AS b1,
             (a*(v*f-e*w) - u*(b*f-c*e) + c*(b*w-c*v)) / det AS b2,
             (a*(d*w-v*e) - b*(b*w-c*v) + u*(b*e-c*d)) / det AS b3
   FROM (SELECT *, a*(d*f-e*e) - b*(b*f-c*e) + c*(b*e-c*d) AS det FROM {name}_m)))"""


@query("m2_grouped_ols_one_feature", sql_rounded("""
SELECT family, count(*) AS n, avg(sales) AS mean_y, regr_slope(sales, onpromotion) AS coef,
       regr_intercept(sales, onpromotion) AS intercept FROM panel GROUP BY family HAVING count(*) >= 30""",
                                                 ["mean_y", "coef", "intercept"]))
def _(spark, sf):
    panel = panel_table(spark, sf)
    models = linear.grouped_ols(panel, ["family"], ["onpromotion"], impute=[])
    return round_all(models.select("family", "n", "mean_y", F.col("coefs")[0].alias("coef"), "intercept"))


EFFECT = PE + "," + cramer("ols", "TRUE")


@query("m2_promotion_effect", sql_rounded("""
SELECT ols.family, seg.segment, b1 AS coef_promo, b2 AS coef_promo_weekend, b3 AS coef_promo_holiday, my AS mean_sale
FROM ols JOIN seg ON ols.family = seg.family WHERE n >= 30""",
                                          ["coef_promo", "coef_promo_weekend", "coef_promo_holiday", "mean_sale"], ctes=EFFECT))
def _(spark, sf):
    panel = promo_panel(spark, sf)
    models = linear.grouped_ols(panel, ["family"], PROMO, impute=[])
    return round_all(linear.promotion_effect(models, segments(spark, sf, panel), PROMO))


def full_effect(spark, sf) -> DataFrame:
    """Promotion coefficients of the models with all candidate features."""
    table = promo_features(spark, sf)
    names = linear.existing(table)
    models = linear.grouped_ols(table, ["family"], names, impute=NULLABLE)
    return linear.promotion_effect(models, segments(spark, sf, table), names)


@query("m2_grouped_ols_all_features")
def _(spark, sf):
    return round_all(full_effect(spark, sf))


@query("p14_promo_uplift", sql_rounded("""
SELECT *, greatest(uplift_normal_pct, uplift_weekend_pct, uplift_holiday_pct) AS uplift_max_pct FROM (
  SELECT *, 100 * uplift_normal_abs / (mean_sale + 1e-9) AS uplift_normal_pct,
         100 * uplift_weekend_abs / (mean_sale + 1e-9) AS uplift_weekend_pct,
         100 * uplift_holiday_abs / (mean_sale + 1e-9) AS uplift_holiday_pct FROM (
    SELECT ols.family, seg.segment, my AS mean_sale, b1 AS coef_promo, b2 AS coef_promo_weekend, b3 AS coef_promo_holiday,
           b1 AS uplift_normal_abs, b1 + b2 AS uplift_weekend_abs, b1 + b3 AS uplift_holiday_abs
    FROM ols JOIN seg ON ols.family = seg.family))""",
                                       ["mean_sale", "coef_promo", "coef_promo_weekend", "coef_promo_holiday",
                                        "uplift_normal_abs", "uplift_weekend_abs", "uplift_holiday_abs",
                                        "uplift_normal_pct", "uplift_weekend_pct", "uplift_holiday_pct",
                                        "uplift_max_pct"], ctes=EFFECT))
def _(spark, sf):
    return round_all(promo_chain(spark, sf))


def promo_chain(spark, sf) -> DataFrame:
    panel = promo_panel(spark, sf)
    models = linear.grouped_ols(panel, ["family"], PROMO, impute=[])
    effect = linear.promotion_effect(models, segments(spark, sf, panel), PROMO)
    return promo.promo_uplift(materialize(effect, "promotion_effect"))


UPLIFT = EFFECT + """,
up AS (SELECT *, greatest(uplift_normal_pct, uplift_weekend_pct, uplift_holiday_pct) AS uplift_max_pct FROM (
  SELECT ols.family, seg.segment, my AS mean_sale, b1 AS coef_promo, 100 * b1 / (my + 1e-9) AS uplift_normal_pct,
         100 * (b1 + b2) / (my + 1e-9) AS uplift_weekend_pct, 100 * (b1 + b3) / (my + 1e-9) AS uplift_holiday_pct
  FROM ols JOIN seg ON ols.family = seg.family))"""


@query("a13_uplift_by_segment", sql_rounded("""
SELECT segment, avg(uplift_normal_pct) AS uplift_normal_pct, avg(uplift_weekend_pct) AS uplift_weekend_pct,
       avg(uplift_holiday_pct) AS uplift_holiday_pct, avg(uplift_max_pct) AS uplift_max_pct FROM up GROUP BY segment""",
                                            A.UPLIFTS, ctes=UPLIFT))
def _(spark, sf):
    return round_all(A.uplift_by_segment(promo_chain(spark, sf)))


@query("r14_top_promo_families", sql_rounded(
    "SELECT family, segment, uplift_max_pct FROM up ORDER BY uplift_max_pct DESC, family LIMIT 10",
    ["uplift_max_pct"], ctes=UPLIFT))
def _(spark, sf):
    top = ranking.top_k(promo_chain(spark, sf), "uplift_max_pct", 10, ["family"])
    return round_all(top.select("family", "segment", "uplift_max_pct"))


@query("r16_promo_elasticity", sql_rounded("""
SELECT family, segment, mean_sale, coef_promo, coef_promo / nullif(mean_sale, 0) * 100 AS promo_uplift_pct,
       family IN (SELECT family FROM up ORDER BY coef_promo / nullif(mean_sale, 0) DESC NULLS LAST, family LIMIT 5) AS labelled FROM up""",
                                           ["mean_sale", "coef_promo", "promo_uplift_pct"], ctes=UPLIFT))
def _(spark, sf):
    points = materialize(promo.promo_elasticity(promo_chain(spark, sf)), "elasticity")
    top = ranking.top_k(points, "promo_uplift_pct", 5, ["family"]).select("family", F.lit(True).alias("labelled"))
    return round_all(points.join(top, "family", "left").withColumn("labelled", F.coalesce("labelled", F.lit(False))))


LO, HI = WHAT_IF_MONTH
WHAT_IF = PE + "," + cramer("ols", f"date < DATE '{LO}'")


@query("m3_promo_what_if", sql_rounded(f"""
SELECT p.date, p.store_nbr, p.family, s.scenario,
       CASE WHEN s.scenario = 'no_promo' THEN b0 ELSE b0 + b1 + b2 * p.is_weekend + b3 * p.is_holiday END AS sales_pred
FROM pe p JOIN ols ON p.family = ols.family CROSS JOIN (VALUES ('with_promo'), ('no_promo')) s(scenario)
WHERE p.date BETWEEN DATE '{LO}' AND DATE '{HI}'""", ["sales_pred"], ctes=WHAT_IF))
def _(spark, sf):
    panel = promo_panel(spark, sf)
    return round_all(linear.promo_what_if(panel, PROMO, LO, HI, impute=[]))


@query("m3_promo_what_if_all_features")
def _(spark, sf):
    table = promo_features(spark, sf)
    return round_all(linear.promo_what_if(table, linear.existing(table), LO, HI, impute=NULLABLE))


@query("m4_baseline_vs_actual", sql_rounded(f"""
SELECT p.family, p.date, sum(p.sales) AS actual, sum(b0) AS baseline, max(CASE WHEN p.onpromotion > 0 THEN 1 ELSE 0 END) AS promo_flag
FROM pe p JOIN ols ON p.family = ols.family WHERE ols.n >= 50 AND p.date BETWEEN DATE '{LO}' AND DATE '{HI}'
GROUP BY p.family, p.date""", ["actual", "baseline"], ctes=WHAT_IF))
def _(spark, sf):
    panel = promo_panel(spark, sf)
    return round_all(linear.baseline_vs_actual(panel, PROMO, LO, HI, impute=[]))


def lasso_table(spark, sf) -> tuple[DataFrame, DataFrame]:
    table = promo_features(spark, sf)
    kept = linear.grouped_lasso(table, ["family"], linear.existing(table), impute=NULLABLE)
    return materialize(kept, "lasso"), table


@query("m5_grouped_lasso")
def _(spark, sf):
    return round_all(lasso_table(spark, sf)[0]).orderBy("family", "feature")


@query("m5_contiguous_folds", more("""
ord AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY date, store_nbr) - 1 AS r,
               count(*) OVER (PARTITION BY family) AS n FROM panel)""", """
SELECT date, store_nbr, family, CAST(CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1)
       ELSE n % 5 + (r - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INT) AS cv FROM ord"""))
def _(spark, sf):
    panel = materialize(sales_panel(spark, sf, oil=False).select(*KEY), "panel")
    return linear.contiguous_folds(panel, ["family"]).select(*KEY, "cv")


# Lasso with one feature in closed form: a soft threshold on the covariance, per training set.
ONE_LASSO = """
sc AS (SELECT family, avg(onpromotion) AS mx, stddev_pop(onpromotion) AS sx FROM panel GROUP BY family),
ord AS (SELECT p.family, p.sales AS y, (p.onpromotion - sc.mx) / sc.sx AS z,
               row_number() OVER (PARTITION BY p.family ORDER BY date, store_nbr) - 1 AS r,
               count(*) OVER (PARTITION BY p.family) AS n FROM panel p JOIN sc ON p.family = sc.family),
cv AS (SELECT *, CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1)
                      ELSE n % 5 + (r - (n % 5) * (n // 5 + 1)) // (n // 5) END AS f FROM ord),
al AS (SELECT unnest([1.0, 0.1, 0.01, 0.001]) AS alpha),
tr AS (SELECT cv.family, g.f, avg(z) AS mz, avg(y) AS my, covar_pop(z, y) AS c, var_pop(z) AS v
       FROM cv JOIN (SELECT DISTINCT f FROM cv) g ON cv.f <> g.f GROUP BY cv.family, g.f),
wt AS (SELECT tr.*, alpha, sign(c) * greatest(abs(c) - alpha, 0) / v AS w FROM tr CROSS JOIN al),
er AS (SELECT family, alpha, avg(mse) AS mse FROM (
         SELECT cv.family, alpha, cv.f, avg((y - my - w * (z - mz)) ** 2) AS mse
         FROM cv JOIN wt ON cv.family = wt.family AND cv.f = wt.f GROUP BY cv.family, alpha, cv.f) GROUP BY family, alpha),
best AS (SELECT family, alpha FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY mse, alpha DESC) AS k FROM er) WHERE k = 1)"""


@query("m5_lasso_one_feature", sql_rounded("""
SELECT b.family, 'onpromotion' AS feature, b.alpha::DOUBLE AS alpha,
       sign(c) * greatest(abs(c) - b.alpha, 0) AS coef_scaled, sign(c) * greatest(abs(c) - b.alpha, 0) / sc.sx AS coef
FROM best b JOIN sc ON b.family = sc.family
JOIN (SELECT family, covar_pop(z, y) AS c FROM cv GROUP BY family) a ON a.family = b.family
WHERE abs(c) - b.alpha > 0""", ["coef_scaled", "coef"], ctes=ONE_LASSO))
def _(spark, sf):
    kept = linear.grouped_lasso(panel_table(spark, sf), ["family"], ["onpromotion"], impute=[])
    return round_all(kept.select("family", "feature", "alpha", "coef_scaled", "coef"))


@query("m1_linear_oof_one_feature", sql_rounded("""
SELECT p.date, p.store_nbr, p.family, m.fold, p.sales AS y_true, m.b0 + m.b1 * p.onpromotion AS y_pred
FROM panel p JOIN (SELECT f.fold, f.test_start, f.test_end, regr_intercept(sales, onpromotion) AS b0, regr_slope(sales, onpromotion) AS b1
                   FROM panel JOIN folds f ON date BETWEEN f.train_start AND f.train_end GROUP BY ALL) m
ON p.date BETWEEN m.test_start AND m.test_end
WHERE p.family IN (SELECT family FROM seg WHERE segment IN ('High', 'Medium'))""", ["y_pred"]))
def _(spark, sf):
    panel = panel_table(spark, sf)
    return round_all(linear.linear_oof(panel.select(*KEY, "sales", "onpromotion"), FOLDS, segments(spark, sf, panel)))


@query("m1_linear_oof_text_feature", sql_rounded("""
SELECT p.date, p.store_nbr, p.family, m.fold, p.sales AS y_true, m.mean AS y_pred
FROM panel p JOIN (SELECT f.fold, f.test_start, f.test_end, type, avg(sales) AS mean
                   FROM panel JOIN folds f ON date BETWEEN f.train_start AND f.train_end GROUP BY ALL) m
ON p.date BETWEEN m.test_start AND m.test_end AND p.type = m.type
WHERE p.family IN (SELECT family FROM seg WHERE segment IN ('High', 'Medium'))""", ["y_pred"]))
def _(spark, sf):
    # With one text feature the least-squares prediction is the mean of its training rows.
    panel = panel_table(spark, sf)
    return round_all(linear.linear_oof(panel.select(*KEY, "sales", "type"), FOLDS, segments(spark, sf, panel)))


# Stand-in for kept features: a coefficient is kept where its one-feature slope is above 0.05.
SLOPES = """
kept AS (SELECT family, feature FROM (
  SELECT family, 'onpromotion' AS feature, regr_slope(sales, onpromotion) AS coef FROM panel GROUP BY family UNION ALL
  SELECT family, 'is_weekend', regr_slope(sales, is_weekend) FROM panel GROUP BY family UNION ALL
  SELECT family, 'is_holiday', regr_slope(sales, is_holiday) FROM panel GROUP BY family) WHERE abs(coef) > 0.05)"""


def kept_features(spark, sf) -> tuple[DataFrame, DataFrame]:
    panel = panel_table(spark, sf)
    parts = None
    for c in ("onpromotion", "is_weekend", "is_holiday"):
        models = linear.grouped_ols(panel, ["family"], [c], impute=[])
        rows = linear.coefficient_table(models, ["family"], [c])
        parts = rows if parts is None else parts.unionByName(rows)
    return parts.where(F.abs("coef") > 0.05), segments(spark, sf, panel)


@query("a11_feature_frequency", sql_rounded("""
SELECT feature, count(DISTINCT family) AS n_families,
       100.0 * count(DISTINCT family) / (SELECT count(DISTINCT family) FROM seg) AS pct_families FROM kept GROUP BY feature""",
                                            ["pct_families"], ctes=SLOPES))
def _(spark, sf):
    return round_all(A.feature_frequency(*kept_features(spark, sf)))


@query("a12_feature_by_segment", more(SLOPES, """
SELECT feature, """ + ", ".join(
    f"count(DISTINCT CASE WHEN segment = '{s}' THEN k.family END) AS \"{s}\"" for s in A.SEGMENTS)
    + " FROM kept k JOIN seg ON k.family = seg.family GROUP BY feature"))
def _(spark, sf):
    kept, seg = kept_features(spark, sf)
    return A.feature_by_segment(joins.with_segment(kept, seg))


@query("m5_lasso_feature_frequency")
def _(spark, sf):
    kept, table = lasso_table(spark, sf)
    return round_all(A.feature_frequency(kept, segments(spark, sf, table)))


# --- quantile forecast -------------------------------------------------------------------

OFFSETS = """
tr AS (SELECT fold, family, sales - rolling_mean_30 AS e FROM feat JOIN folds ON date BETWEEN train_start AND train_end
       WHERE rolling_mean_30 IS NOT NULL),
off AS (SELECT fold, family, quantile_cont(e, 0.05) AS o1, quantile_cont(e, 0.5) AS o2, quantile_cont(e, 0.95) AS o3
        FROM tr GROUP BY fold, family),
qq AS (SELECT folds.fold, f.date, f.store_nbr, f.family, greatest(f.rolling_mean_30 + o1, 0) AS q05,
              greatest(f.rolling_mean_30 + o2, 0) AS m, greatest(f.rolling_mean_30 + o3, 0) AS h
       FROM feat f JOIN folds ON f.date BETWEEN test_start AND test_end
       JOIN off ON f.family = off.family AND folds.fold = off.fold WHERE rolling_mean_30 IS NOT NULL)"""


@query("m15_quantiles_from_residuals", sql_rounded("""
SELECT fold, date, store_nbr, family, q05, greatest(q05, m) AS q50, greatest(q05, m, h) AS q95 FROM qq""",
                                                   ["q05", "q50", "q95"], ctes=OFFSETS))
def _(spark, sf):
    panel = sales_panel(spark, sf, oil=False)
    table = materialize(windows.series_select(panel, windows.add_rolling([30], "mean")).na.drop(
        subset=["rolling_mean_30"]).select(*KEY, "sales", "rolling_mean_30"), "features")
    rows, by = folds.assign_folds(table, FOLDS), ["fold", "family"]
    offsets = linear.residual_quantiles(rows.where("split = 'train'"), by, "sales", "rolling_mean_30", linear.TAUS)
    scored = linear.add_quantiles(rows.where("split = 'test'"), offsets, by, "rolling_mean_30")
    return round_all(scored.select("fold", *KEY, "q05", "q50", "q95"))


FITTED = """
fr AS (SELECT f.*, folds.fold, date <= folds.train_end AS is_train FROM feat f JOIN folds
       ON f.date BETWEEN folds.train_start AND folds.train_end OR f.date BETWEEN folds.test_start AND folds.test_end
       WHERE rolling_mean_30 IS NOT NULL),
md AS (SELECT fold, family, regr_intercept(sales, rolling_mean_30) AS b0, regr_slope(sales, rolling_mean_30) AS b1
       FROM fr WHERE is_train GROUP BY fold, family),
sc AS (SELECT fr.*, b0 + b1 * rolling_mean_30 AS p FROM fr JOIN md ON fr.fold = md.fold AND fr.family = md.family),
off AS (SELECT fold, family, quantile_cont(sales - p, 0.05) AS o1, quantile_cont(sales - p, 0.5) AS o2,
               quantile_cont(sales - p, 0.95) AS o3 FROM sc WHERE is_train GROUP BY fold, family)"""


@query("m15_quantile_forecast_one_feature", sql_rounded("""
SELECT sc.fold, date, store_nbr, sc.family, sales, greatest(p + o1, 0) AS q05, greatest(p + o1, p + o2, 0) AS q50,
       greatest(p + o1, p + o2, p + o3, 0) AS q95
FROM sc JOIN off ON sc.fold = off.fold AND sc.family = off.family WHERE NOT is_train""", ["q05", "q50", "q95"], ctes=FITTED))
def _(spark, sf):
    panel = sales_panel(spark, sf, oil=False)
    table = materialize(windows.series_select(panel, windows.add_rolling([30], "mean")).na.drop(
        subset=["rolling_mean_30"]).select(*KEY, "sales", "rolling_mean_30"), "features")
    split = folds.assign_folds(table, FOLDS)
    scored = linear.quantile_forecast(split.where("split = 'train'"), split.where("split = 'test'"),
                                      ["fold", "family"], ["rolling_mean_30"])
    return round_all(scored.select("fold", *KEY, "sales", "q05", "q50", "q95"))


SEQUENCE_FEATURES = ["onpromotion", "sales_lag_7", "sales_lag_14", "sales_lag_30", "rolling_mean_7",
                     "rolling_mean_30", "rolling_std_7", "rolling_std_30"]


@query("m15_quantile_forecast")
def _(spark, sf):
    base = panel_table(spark, sf)
    panel = windows.series_select(base, [
        *windows.add_lags([7, 14, 30]), *windows.add_rolling([7, 30], "mean"), *windows.add_rolling([7, 30], "std")])
    table = materialize(panel.na.drop(subset=SEQUENCE_FEATURES).select(*KEY, "sales", *SEQUENCE_FEATURES), "features")
    split = folds.assign_folds(table, FOLDS)
    scored = linear.quantile_forecast(split.where("split = 'train'"), split.where("split = 'test'"),
                                      ["fold", "family"], SEQUENCE_FEATURES)
    scored = scored.withColumnRenamed("sales", "y_true")
    return round_all(reports.quantile_family_report(scored, segments(spark, sf, base)))


# --- attribution of a linear model -------------------------------------------------------

CONTRIBUTED = EFFECT + """,
ct AS (
  SELECT date, store_nbr, pe.family, 'onpromotion' AS feature, onpromotion::DOUBLE AS value, b1 * (onpromotion - m1) AS contribution FROM pe JOIN ols ON pe.family = ols.family
  UNION ALL SELECT date, store_nbr, pe.family, 'promo_weekend', promo_weekend::DOUBLE, b2 * (promo_weekend - m2) FROM pe JOIN ols ON pe.family = ols.family
  UNION ALL SELECT date, store_nbr, pe.family, 'promo_holiday', promo_holiday::DOUBLE, b3 * (promo_holiday - m3) FROM pe JOIN ols ON pe.family = ols.family)"""


def promo_contributions(spark, sf) -> DataFrame:
    panel = promo_panel(spark, sf)
    models = materialize(linear.grouped_ols(panel, ["family"], PROMO, impute=[]), "models")
    return attribution.contributions(panel, models, ["family"], PROMO, KEY)


@query("m17_contributions", sql_rounded("SELECT * FROM ct", ["value", "contribution"], ctes=CONTRIBUTED))
def _(spark, sf):
    return round_all(promo_contributions(spark, sf))


@query("m17_contribution_summary", sql_rounded(
    "SELECT feature, avg(abs(contribution)) AS importance FROM ct GROUP BY feature ORDER BY importance DESC LIMIT 5",
    ["importance"], ctes=CONTRIBUTED))
def _(spark, sf):
    return round_all(attribution.contribution_summary(promo_contributions(spark, sf), 5))


@query("m17_dependence", sql_rounded(
    "SELECT date, store_nbr, family, value, contribution FROM ct WHERE feature = 'onpromotion'",
    ["value", "contribution"], ctes=CONTRIBUTED))
def _(spark, sf):
    return round_all(attribution.dependence(promo_contributions(spark, sf), "onpromotion"))
