"""Identities that fitted models must meet, each with a SQL twin.

Values of trees and of iterative fits have no SQL form; what they cover, how parts add up and
what least squares leaves over do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators import additive, arx, linear
from panelcast.operators.features import before_date
from panelcast.plans.catalog_base import FILLED
from panelcast.plans.catalog_linear import HI, LO, NULLABLE, promo_features
from panelcast.plans.catalog_series import daily
from panelcast.plans.oracle import more, sql
from panelcast.plans.registry import QUERIES, query
from panelcast.session import materialize

FOLD_ROWS = """
SELECT f.fold, p.family, count(*) AS n, sum(p.sales) AS sales FROM folds f
JOIN panel p ON p.date BETWEEN f.test_start AND f.test_end JOIN seg ON p.family = seg.family {where} GROUP BY f.fold, p.family"""


def covered(oof: DataFrame) -> DataFrame:
    """Rows and actual sales that predictions exist for, by fold and family."""
    usable = F.col("y_pred").isNotNull() & (F.col("y_pred") >= 0)
    return oof.where(usable).groupBy("fold", "family").agg(F.count(F.lit(1)).alias("n"), F.sum("y_true").alias("sales"))


@query("m6_forest_rows", sql(FOLD_ROWS.format(where="WHERE seg.segment = 'Medium'")))
def _(spark, sf):
    return covered(QUERIES["m6_forest_medium"](spark, sf))


@query("m7_core_rows", sql(FOLD_ROWS.format(where="WHERE seg.segment = 'High'")))
def _(spark, sf):
    return covered(QUERIES["m7_core_forest"](spark, sf))


@query("m8_hurdle_rows", sql(FOLD_ROWS.format(where="WHERE seg.segment <> 'High'")))
def _(spark, sf):
    return covered(QUERIES["m8_hurdle_forest"](spark, sf))


@query("m16_importance_total", sql("SELECT CAST(17 AS BIGINT) AS n_features, 1.0 AS total"))
def _(spark, sf):
    table = QUERIES["m16_importance"](spark, sf)
    return table.agg(F.count_distinct("Feature").alias("n_features"), F.round(F.sum("Importance"), 6).alias("total"))


def _near_zero(c, scale) -> Column:
    """0.0 where ``c`` is nothing beside ``scale``."""
    return F.when(F.abs(c) <= 1e-7 * (1 + F.abs(scale)), 0.0).otherwise(c)


@query("m2_residuals_are_orthogonal", sql("""
SELECT family, 0.0 AS residual, 0.0 AS with_promo, 0.0 AS with_weekend, 0.0 AS with_holiday FROM panel GROUP BY family"""))
def _(spark, sf):
    table = promo_features(spark, sf)
    features = linear.existing(table)
    models = materialize(linear.grouped_ols(table, ["family"], features, "sales", min_n=1, impute=NULLABLE), "ols")
    e = F.col("sales") - F.col("y_pred")
    sums = linear.predict(table, models, ["family"], features).groupBy("family").agg(
        F.sum(F.abs("sales")).alias("scale"), F.sum(e).alias("residual"), *[
            F.sum(e * F.col(c)).alias(name) for name, c in
            (("with_promo", "onpromotion"), ("with_weekend", "promo_weekend"), ("with_holiday", "promo_holiday"))])
    return sums.select("family", *[_near_zero(F.col(c), F.col("scale")).alias(c)
                                   for c in ("residual", "with_promo", "with_weekend", "with_holiday")])


@query("m3_promotion_adds_its_coefficients", sql(f"""
SELECT family, count(*) AS n, 0.0 AS gap FROM panel WHERE date BETWEEN DATE '{LO}' AND DATE '{HI}' GROUP BY family"""))
def _(spark, sf):
    table = promo_features(spark, sf)
    features = linear.existing(table)
    rows = materialize(linear.promo_what_if(table, features, LO, HI, impute=NULLABLE), "what_if")
    models = linear.grouped_ols(before_date(table, LO), ["family"], features, "sales", min_n=1, impute=NULLABLE)
    coefs = models.select("family", *[
        F.col("coefs")[features.index(c)].alias(f"b_{c}") for c in ("onpromotion", "promo_weekend", "promo_holiday")])
    key = ["date", "store_nbr", "family"]
    days = table.select(*key, "is_weekend", "is_holiday")
    both = [rows.where(F.col("scenario") == s).select(*key, F.col("sales_pred").alias(s)) for s in ("with_promo", "no_promo")]
    added = F.col("b_onpromotion") + F.col("b_promo_weekend") * F.col("is_weekend") + F.col("b_promo_holiday") * F.col("is_holiday")
    gap = F.col("with_promo") - F.col("no_promo") - added
    joined = both[0].join(both[1], key).join(days, key).join(materialize(coefs, "coefs"), "family")
    return joined.groupBy("family").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(_near_zero(gap, F.col("with_promo")))).alias("gap"))


LAST_DAYS = """
last90 AS (SELECT family, sales FROM (SELECT family, sales, row_number() OVER (PARTITION BY family ORDER BY date DESC) AS r
                                      FROM filled) WHERE r <= 90)"""


@query("m13_band_is_centred", more(f"{FILLED}, {LAST_DAYS}", """
SELECT family, count(*) AS n, sum(sales) AS sales, 0.0 AS off_centre FROM last90 GROUP BY family"""))
def _(spark, sf):
    forecast = additive.additive_forecast(daily(spark, sf))[0]
    off = F.col("lower") + F.col("upper") - 2 * F.col("y_pred")
    return forecast.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("y_true").alias("sales"),
                                          F.max(F.abs(_near_zero(off, F.col("y_pred")))).alias("off_centre"))


@query("m13_minimum_of_the_posterior", more(f"{FILLED}, {LAST_DAYS}", """
SELECT family, 0.0 AS excess, CAST(0 AS BIGINT) AS too_many_bends FROM last90 GROUP BY family"""))
def _(spark, sf):
    train, _, scales, models = additive.split_and_fit(daily(spark, sf), 90)
    table = additive.optimality(train, scales, models)
    return table.select("family", F.round("excess", 4).alias("excess"),
                        (F.col("n_bends") > additive.BENDS).cast("long").alias("too_many_bends"))


@query("m14_parts_sum_to_the_forecast", more(f"{FILLED}, {LAST_DAYS}", """
SELECT family, count(*) AS n, 0.0 AS gap FROM last90 GROUP BY family"""))
def _(spark, sf):
    forecast, parts = additive.additive_forecast(daily(spark, sf))
    total = sum((F.col(f"part_{n}") for n in additive.PARTS), F.lit(0.0))
    both = forecast.join(parts.select("family", "date", total.alias("total")), ["family", "date"])
    gap = _near_zero(F.col("total") - F.col("y_pred"), F.col("y_pred"))
    return both.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(gap)).alias("gap"))


@query("m12_forecast_covers_the_horizon", more(f"{FILLED}, {LAST_DAYS}", """
SELECT family, count(*) AS n, sum(sales) AS sales, CAST(0 AS BIGINT) AS bad_bands FROM last90 GROUP BY family"""))
def _(spark, sf):
    forecast = arx.seasonal_arx(daily(spark, sf))[0]
    bad = (F.col("lower") > F.col("y_pred")) | (F.col("upper") < F.col("y_pred")) | (F.col("upper") <= F.col("lower"))
    return forecast.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("y_true").alias("sales"),
                                          F.count_if(bad).alias("bad_bands"))
