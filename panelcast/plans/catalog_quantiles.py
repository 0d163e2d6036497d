"""Quantile models of the pinball loss over all folds, beside residual quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators import folds, linear, quantile_fit, windows
from panelcast.plans.catalog_base import KEY, round_all
from panelcast.plans.catalog_linear import SEQUENCE_FEATURES
from panelcast.plans.oracle import sql
from panelcast.plans.panel import FOLDS, panel_table
from panelcast.plans.registry import query
from panelcast.session import materialize

BY = ["fold", "family"]


def sequence_rows(spark, sf) -> DataFrame:
    """Rows of all folds with the features of the sequence model and a split."""
    panel = windows.series_select(panel_table(spark, sf), [
        *windows.add_lags([7, 14, 30]), *windows.add_rolling([7, 30], "mean"), *windows.add_rolling([7, 30], "std")])
    table = panel.na.drop(subset=SEQUENCE_FEATURES).select(*KEY, "sales", *SEQUENCE_FEATURES)
    return materialize(folds.assign_folds(table, FOLDS), "sequence_rows")


@query("m15_direct_quantiles")
def _(spark, sf):
    """Mean pinball loss of the test rows by fold and level: fitted on that loss, and from residuals."""
    rows = sequence_rows(spark, sf)
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    both = [
        quantile_fit.direct_quantile_forecast(train, test, BY, SEQUENCE_FEATURES).withColumn("fit", F.lit("direct")),
        linear.quantile_forecast(train, test, BY, SEQUENCE_FEATURES).withColumn("fit", F.lit("residual"))]
    scored = both[0].unionByName(both[1].select(*both[0].columns))
    losses = [F.avg(quantile_fit.pinball(F.col("sales"), F.col(name), tau)).alias(name) for name, tau in linear.TAUS.items()]
    return round_all(scored.groupBy("fold", "fit").agg(*losses))


@query("m15_direct_quantiles_balance", sql(f"""
SELECT folds.fold, family, level, count(*) AS n, true AS balanced FROM feat
JOIN folds ON date BETWEEN train_start AND train_end CROSS JOIN (VALUES ('q05'), ('q50'), ('q95')) AS l(level)
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SEQUENCE_FEATURES)} GROUP BY folds.fold, family, level"""))
def _(spark, sf):
    """The loss has no slope along any coefficient, beyond the rows a model passes through."""
    train = sequence_rows(spark, sf).where("split = 'train'")
    models = quantile_fit.quantile_models(train, BY, SEQUENCE_FEATURES)
    slopes = quantile_fit.balance(train, models, BY, SEQUENCE_FEATURES)
    return slopes.select("fold", "family", "level", "n", (F.array_max("slope") <= 0.01).alias("balanced"))
