"""Forests, boosting and the global linear model, with their reports.

Tree counts and depths are small here so that the checks end soon; the operators'
defaults are the real settings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators import attribution, linear, reports, trees, windows
from panelcast.functions import columns as C
from panelcast.plans.catalog_base import KEY, round_all
from panelcast.plans.oracle import sql_rounded
from panelcast.plans.panel import FOLDS, YEAR_WEIGHTS, sales_panel, segments
from panelcast.plans.registry import query
from panelcast.session import materialize


def model_table(spark, sf) -> DataFrame:
    panel = windows.series_select(
        sales_panel(spark, sf, transactions=True),
        [*windows.add_lags([7, 14]), *windows.add_rolling([30], "mean")],
    )
    return materialize(panel, "model_table")


def core_families(spark, sf, table: DataFrame) -> list[str]:
    """The core families: a short configured list in practice, here the High segment."""
    return [r["family"] for r in segments(spark, sf, table).where("segment = 'High'").collect()]


@query("m1_linear_oof")
def _(spark, sf):
    table = model_table(spark, sf)
    oof = linear.linear_oof(table, FOLDS, segments(spark, sf, table))
    return round_all(oof)


@query("m1_linear_family_report")
def _(spark, sf):
    table = model_table(spark, sf)
    seg = segments(spark, sf, table)
    oof = linear.linear_oof(table, FOLDS, seg).join(seg, "family")
    return round_all(reports.linear_family_report(materialize(oof, "linear_oof")))


def _medium(spark, sf, fold=FOLDS[0], table=None):
    table = model_table(spark, sf) if table is None else table
    return trees.prepare_medium(table, segments(spark, sf, table), fold, YEAR_WEIGHTS)


def _each_fold(predict) -> DataFrame:
    return trees.union([predict(fold) for fold in FOLDS])


@query("m6_forest_medium")
def _(spark, sf):
    table = model_table(spark, sf)
    return _each_fold(lambda fold: trees.forest_fit_predict(
        *_medium(spark, sf, fold, table), fold[0], trees=10, depth=6)[1])


@query("m7_core_forest")
def _(spark, sf):
    table = model_table(spark, sf)
    core = core_families(spark, sf, table)
    return _each_fold(lambda fold: trees.core_forest(table, core, fold, trees=10, depth=6))


@query("m8_hurdle_forest")
def _(spark, sf):
    table = model_table(spark, sf)
    core = core_families(spark, sf, table)
    return _each_fold(lambda fold: trees.hurdle_forest(table, core, fold, trees=10, depth=6))


@query("m8_hurdle_combine", sql_rounded("""
SELECT date, store_nbr, family, onpromotion / (onpromotion + 1.0) * greatest(exp(ln(1 + sales_lag_7)) - 1, 0) AS y_pred
FROM feat WHERE sales_lag_7 IS NOT NULL""", ["y_pred"]))
def _(spark, sf):
    panel = windows.series_select(sales_panel(spark, sf, oil=False), windows.add_lags([7])).where("sales_lag_7 is not null")
    chance = F.col("onpromotion") / (F.col("onpromotion") + 1.0)
    return round_all(panel.select(*KEY, trees.hurdle(chance, C.log_target("sales_lag_7")).alias("y_pred")))


@query("m9_two_tier_forest")
def _(spark, sf):
    table = model_table(spark, sf)
    oof = trees.two_tier_forest(table, core_families(spark, sf, table), FOLDS, trees=5, core_depth=5, rest_depth=5)
    return round_all(reports.forest_complete_report(materialize(oof, "forest_oof")))


@query("m10_boosted_oof")
def _(spark, sf):
    table = model_table(spark, sf)
    oof = trees.boosted_oof(table, FOLDS, iterations=12, depth=6, step=0.15)
    return round_all(reports.boosted_fold_report(materialize(oof, "boosted_oof"), table, FOLDS))


@query("m10_boosted_oof_missing_text")
def _(spark, sf):
    """The second variant: its own step, missing texts under a name of their own."""
    table = model_table(spark, sf)
    oof = trees.boosted_oof(table, FOLDS, iterations=10, depth=6, step=0.05, text_fill="missing")
    return round_all(reports.boosted_family_report(materialize(oof, "boosted_oof")))


@query("m11_boosted_medium")
def _(spark, sf):
    table = model_table(spark, sf)
    scored = _each_fold(lambda fold: trees.boosted_fit_predict(
        *_medium(spark, sf, fold, table), fold[0], iterations=10, depth=6, step=0.1)[1])
    return round_all(reports.medium_family_report(materialize(scored, "boosted_oof")))


@query("m16_importance")
def _(spark, sf):
    train, test = _medium(spark, sf)
    model, _ = trees.forest_fit_predict(train, test, 1, trees=10, depth=6)
    return trees.importance(model.stages[-1], trees.MEDIUM_FEATURES, spark)


@query("m17_permutation_importance")
def _(spark, sf):
    """All test rows of all folds."""
    table = model_table(spark, sf)

    def of_fold(fold) -> DataFrame:
        train, test = _medium(spark, sf, fold, table)
        model, _ = trees.forest_fit_predict(train, test, fold[0], trees=10, depth=6)
        found = attribution.permutation_importance(model, test, trees.MEDIUM_FEATURES, trees.IDS)
        return found.withColumn("fold", F.lit(fold[0]))

    return _each_fold(of_fold)
