"""Linear quantile models fitted on the pinball loss itself, one per group and level.

The loss of a residual r at level t is max(t r, (t - 1) r). Around the present residuals it lies
below a parabola that touches it, so each pass minimises the parabolas: weighted least squares
with weight 1 / (|r| + e) and a push of 2 t - 1 towards the level, which never raises the
smoothed loss; steps go nearly twice as far, which does not raise it either. A pass is one aggregation of weighted moments by group and level with a map-side
part; all groups and levels share it, and only the small systems are solved in Python, dealt
over the tasks. The smoothing e shrinks from pass to pass, in units of the group's deviation.

Fits start from least squares moved by the residuals' quantile, so on the training rows they end
at or below the loss of residual quantiles. Predictions of the levels do not cross.

Cases: rows with a null in the target or a feature are left out of a fit and get no prediction; a
constant feature gets coefficient 0; a group with one row predicts it; groups without a model
get no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import clip_lower, join_null_safe
from panelcast.operators.linear import TAUS
from panelcast.session import materialize, spread

PASSES = 32
# Smoothing of the first pass and by how much each pass shrinks it, down to the least.
SMOOTH, SHRINK, LEAST = 0.02, 0.9, 1e-4
# Steps towards a parabola's minimum: up to twice as far the parabola is no higher than before.
RELAX = 1.9


def pinball(y: Column, yhat: Column, tau: Column | float) -> Column:
    """Loss of a prediction of the level ``tau``."""
    e = y - yhat
    return F.greatest(tau * e, (tau - 1) * e)


def scaled(df: DataFrame, features: list[str]) -> list[Column]:
    """1 and each feature less its mean, in deviations (0 for a constant one)."""
    def one(k: int, c: str) -> Column:
        off = F.col(c).cast("double") - F.col("means")[k]
        return F.when(F.col("deviations")[k] > 0, off / F.col("deviations")[k]).otherwise(0.0)

    return [F.lit(1.0), *[one(k, c) for k, c in enumerate(features)]]


def group_scales(df: DataFrame, by: list[str], features: list[str], y: str) -> DataFrame:
    """(by, n, means, deviations, spread): the units a group's fit works in."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col(c).cast("double")) for c in features]).alias("means"),
        F.array(*[F.coalesce(F.stddev_pop(F.col(c).cast("double")), F.lit(0.0)) for c in features]).alias("deviations"),
        F.coalesce(F.stddev_pop(F.col(y).cast("double")), F.lit(0.0)).alias("spread"))


def solve(moments: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least-norm solution, so that constant and repeated features do no harm."""
    return np.linalg.lstsq(moments, right, rcond=1e-10)[0]


def weighted_fit(rows: DataFrame, keys: list[str], size: int, weight: Column, push: Column) -> DataFrame:
    """(keys, coefs) that minimise the weighted squares less the push, from one aggregation."""
    z, y = [F.col(f"__z{k}") for k in range(size)], F.col("__y")
    sums = [F.sum(weight * z[i] * z[j]) for i in range(size) for j in range(i + 1)]
    sides = [F.sum((weight * y + push) * z[i]) for i in range(size)]
    reduced = rows.groupBy(*keys).agg(F.array(*sums).alias("moments"), F.array(*sides).alias("sides"))
    lower = np.tril_indices(size)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coefs = []
            for moments, right in zip(batch["moments"], batch["sides"]):
                m = np.zeros((size, size))
                m[lower] = moments
                coefs.append(solve(m + np.tril(m, -1).T, np.asarray(right)))
            yield batch.drop(columns=["moments", "sides"]).assign(coefs=coefs)

    fields = ", ".join(f"`{k}` {reduced.schema[k].dataType.simpleString()}" for k in keys)
    return spread(reduced, keys).mapInPandas(fit, f"{fields}, coefs array<double>")


def fitted(size: int) -> Column:
    return sum((F.col("coefs")[k] * F.col(f"__z{k}") for k in range(1, size)), F.col("coefs")[0])


def quantile_models(df: DataFrame, by: list[str], features: list[str], y: str = "sales",
                    taus: dict[str, float] = TAUS, passes: int = PASSES) -> DataFrame:
    """(by, n, means, deviations, spread, level, tau, coefs): a model per group and level."""
    usable = df.select(*by, *features, y).na.drop(subset=[*features, y])
    scales = materialize(group_scales(usable, by, features, y), "quantile_scales")
    z = scaled(usable, features)
    size = len(z)
    rows = materialize(join_null_safe(usable, scales, by).select(
        *by, "spread", F.col(y).cast("double").alias("__y"), *[c.alias(f"__z{k}") for k, c in enumerate(z)]), "quantile_rows")
    centre = materialize(weighted_fit(rows, by, size, F.lit(1.0), F.lit(0.0)), "centre")
    residual = F.col("__y") - fitted(size)
    moved = join_null_safe(rows, centre, by).groupBy(*by).agg(
        F.percentile_approx(residual, list(taus.values()), 1000).alias("moves"))
    levels = F.array(*[F.struct(F.lit(name).alias("level"), F.lit(tau).alias("tau"), F.lit(k).alias("at"))
                       for k, (name, tau) in enumerate(taus.items())])
    models = materialize(join_null_safe(centre, materialize(moved, "moves"), by).select(
        *by, "coefs", "moves", F.inline(levels)).select(
        *by, "level", "tau", F.concat(F.array(F.col("coefs")[0] + F.col("moves")[F.col("at")]),
                                      F.slice("coefs", 2, max(size - 1, 1))).alias("coefs")), "quantile_models")
    # A group without spread has nothing to weigh: its start is its fit.
    smooth = SMOOTH
    for _ in range(passes):
        floor = F.greatest(F.col("spread") * smooth, F.lit(1e-12))
        weighed = join_null_safe(rows, models, by).select(
            *by, "level", "tau", "__y", *[f"__z{k}" for k in range(size)], (1.0 / (floor + F.abs(residual))).alias("__w"))
        keys = [*by, "level", "tau"]
        fit = weighted_fit(weighed, keys, size, F.col("__w"), 2 * F.col("tau") - 1).withColumnRenamed("coefs", "fit")
        step = F.zip_with("coefs", "fit", lambda old, new: old + RELAX * (new - old))
        models = materialize(join_null_safe(models, fit, keys).select(*keys, step.alias("coefs")), "quantile_models")
        smooth = max(smooth * SHRINK, LEAST)
    return join_null_safe(scales, models, by)


def predict_quantiles(df: DataFrame, models: DataFrame, by: list[str], features: list[str], names: list[str] = tuple(TAUS)) -> DataFrame:
    """``df`` with one column per level, ascending, never negative and never crossing."""
    wide = materialize(models.groupBy(*by).agg(
        F.first("means").alias("means"), F.first("deviations").alias("deviations"),
        *[F.max_by("coefs", F.col("level") == name).alias(f"__c_{name}") for name in names]), "wide_models")
    joined = join_null_safe(df, wide, by)
    z = scaled(df, features)
    previous = None
    for name in names:
        value = clip_lower(sum((F.col(f"__c_{name}")[k] * z[k] for k in range(1, len(z))), F.col(f"__c_{name}")[0]))
        joined = joined.withColumn(name, value if previous is None else F.when(value.isNotNull(), F.greatest(value, F.col(previous))))
        previous = name
    return joined.drop("means", "deviations", *[f"__c_{name}" for name in names])


def direct_quantile_forecast(train: DataFrame, test: DataFrame, by: list[str], features: list[str], y: str = "sales") -> DataFrame:
    """q05, q50 and q95 of the test rows from models of the pinball loss."""
    return predict_quantiles(test, quantile_models(train, by, features, y), by, features)


def balance(df: DataFrame, models: DataFrame, by: list[str], features: list[str], y: str = "sales", near: float = 0.01) -> DataFrame:
    """(by, level, tau, n, slope): the slope of the loss along each coefficient that the rows leave open.

    A row off the model pulls by tau or tau - 1; a row that the model passes through, within
    ``near`` deviations, can pull either way and takes up as much. At the minimum nothing is
    left: slopes are shares of the sum of absolute values, 0 where they vanish.
    """
    z = scaled(df, features)
    yhat = sum((F.col("coefs")[k] * z[k] for k in range(1, len(z))), F.col("coefs")[0])
    rows = join_null_safe(df.na.drop(subset=[*features, y]), models.drop("n"), by).withColumn("__r", F.col(y) - yhat)
    through = F.abs("__r") <= near * F.col("spread")
    pull = F.when(through, 0.0).when(F.col("__r") < 0, F.col("tau") - 1).otherwise(F.col("tau"))
    slack = F.when(through, F.greatest(F.col("tau"), 1 - F.col("tau"))).otherwise(0.0)

    def left(c: Column) -> Column:
        return F.greatest(F.abs(F.sum(pull * c)) - F.sum(slack * F.abs(c)), F.lit(0.0)) / F.greatest(F.sum(F.abs(c)), F.lit(1e-12))

    return rows.groupBy(*by, "level", "tau").agg(F.count(F.lit(1)).alias("n"), F.array(*[left(c) for c in z]).alias("slope"))
