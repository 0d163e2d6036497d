"""Forecast error metrics from additive sums.

``error_sums`` makes one pass over the predictions. Fold, family, segment and pooled
rows all come from its small result (``pool``), and ``derive`` turns sums into metrics.
The reports use different conventions for the same metric name, so each convention is
a named variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import join_null_safe

# float64 machine epsilon, the positive floor of a ratio, the normal
# quantile of a 95 % band, the tolerance of the accuracy rate.
MACHINE_EPS = 2.220446049250313e-16
RATIO_FLOOR = 1e-6
Z95 = 1.96
TOLERANCE = 0.2


def _ratio(mask: Column | None, numerator: Column, denominator: Column) -> Column:
    term = F.try_divide(numerator, denominator)
    return F.sum(term) if mask is None else F.sum(F.when(mask, term))


def error_sums(df: DataFrame, by: list[str], y: str = "y_true", yhat: str = "y_pred",
               lower: str | None = None, upper: str | None = None) -> DataFrame:
    """Sums per group from which every metric follows; unused ones are pruned.

    Rows without an actual or predicted value count nowhere.
    """
    complete = F.col(y).isNotNull() & F.col(yhat).isNotNull()
    t, p = F.when(complete, F.col(y)), F.when(complete, F.col(yhat))
    err = F.abs(t - p)
    aggregates = [
        F.count(err).alias("n"),
        F.sum(err).alias("abs_err"),
        F.sum((t - p) * (t - p)).alias("sq_err"),
        F.sum(t).alias("sum_y"),
        F.sum(F.abs(t)).alias("abs_y"),
        (F.var_pop(t) * F.count(t)).alias("m2_y"),
        F.min(t).alias("min_y"),
        F.max(t).alias("max_y"),
        F.count_if(t != 0).alias("n_nonzero"),
        F.count_if(t > 0).alias("n_positive"),
        _ratio(t != 0, err, F.abs(t)).alias("ratio_nonzero"),
        _ratio(None, err, F.when(t == 0, 1.0).otherwise(F.abs(t))).alias("ratio_one"),
        _ratio(t > 0, err, t).alias("ratio_positive"),
        _ratio(None, err, F.greatest(t, F.lit(RATIO_FLOOR))).alias("ratio_floor"),
        _ratio(None, err, F.greatest(F.abs(t), F.lit(MACHINE_EPS))).alias("ratio_eps"),
        F.count_if(err <= TOLERANCE * F.greatest(t, F.lit(RATIO_FLOOR))).alias("hit_floor"),
        F.count_if(err <= TOLERANCE * F.abs(t)).alias("hit_abs"),
        F.count_if(F.when(t == 0, p == 0).otherwise(F.try_divide(err, t) <= TOLERANCE)).alias("hit_ratio"),
        F.sum(t - p).alias("sum_err"),
        (F.var_pop(t - p) * F.count(t - p)).alias("m2_err"),
    ]
    if lower is not None and upper is not None:
        aggregates += [
            F.count_if((t >= F.col(lower)) & (t <= F.col(upper))).alias("covered"),
            F.sum(F.col(upper) - F.col(lower)).alias("width"),
        ]
    return df.groupBy(*by).agg(*aggregates)


def pool(sums: DataFrame, by: list[str]) -> DataFrame:
    """Sums of coarser groups (``by=[]`` for one row) from sums of finer ones.

    Spread around the group means is carried over, spread of the means is added.
    """
    def spread(m2: str, total: str) -> Column:
        within = F.sum(m2)
        between = F.sum(F.try_divide(F.col(total) * F.col(total), F.col("n"))) - F.try_divide(
            F.sum(total) * F.sum(total), F.sum("n")
        )
        return F.greatest(within + between, F.lit(0.0))

    special = {
        "min_y": F.min("min_y"),
        "max_y": F.max("max_y"),
        "m2_y": spread("m2_y", "sum_y"),
        "m2_err": spread("m2_err", "sum_err"),
    }
    known = [
        "n", "abs_err", "sq_err", "sum_y", "abs_y", "m2_y", "min_y", "max_y", "n_nonzero",
        "n_positive", "ratio_nonzero", "ratio_one", "ratio_positive", "ratio_floor",
        "ratio_eps", "hit_floor", "hit_abs", "hit_ratio", "sum_err", "m2_err", "covered", "width",
    ]
    columns = [c for c in known if c in sums.columns]
    return sums.groupBy(*by).agg(*[special.get(c, F.sum(c)).alias(c) for c in columns])


def _per_row(c: str) -> Column:
    return F.try_divide(F.col(c), F.col("n"))


def _constant() -> Column:
    return F.col("min_y") == F.col("max_y")


def _r2() -> Column:
    return 1 - F.try_divide(F.col("sq_err"), F.col("m2_y"))


def mae() -> Column:
    return _per_row("abs_err")


def rmse() -> Column:
    return F.sqrt(_per_row("sq_err"))


def mean_sale() -> Column:
    return _per_row("sum_y")


def mape(variant: str) -> Column:
    """a: rows y<>0, b: 1 where y=0, c: rows y>0 else 0, d: floor, e: epsilon ratio, f: rows y>0 else null."""
    return {
        "a": 100 * F.try_divide(F.col("ratio_nonzero"), F.col("n_nonzero")),
        "b": 100 * _per_row("ratio_one"),
        "c": F.coalesce(100 * F.try_divide(F.col("ratio_positive"), F.col("n_positive")), F.lit(0.0)),
        "d": 100 * _per_row("ratio_floor"),
        "e": _per_row("ratio_eps"),
        "f": 100 * F.try_divide(F.col("ratio_positive"), F.col("n_positive")),
    }[variant]


def wape(variant: str) -> Column:
    """a: over sum of |y|, b: over sum of y else 0, c: MAE over mean else 0, d: null unless mean > 0."""
    return {
        "a": F.try_divide(F.col("abs_err"), F.col("abs_y")),
        "b": F.coalesce(F.try_divide(F.col("abs_err"), F.col("sum_y")), F.lit(0.0)),
        "c": F.coalesce(F.try_divide(mae(), mean_sale()), F.lit(0.0)),
        "d": F.when(mean_sale() > 0, F.try_divide(mae(), mean_sale())),
    }[variant]


def r2(variant: str) -> Column:
    """Constant y gives a: 0, b: null, c: 1 if perfect else 0 (one row: null)."""
    constant = {
        "a": F.lit(0.0),
        "b": F.lit(None).cast("double"),
        "c": F.when(F.col("n") < 2, F.lit(None).cast("double"))
        .when(F.col("sq_err") == 0, 1.0)
        .otherwise(0.0),
    }[variant]
    return F.when(_constant(), constant).otherwise(_r2())


def accuracy(variant: str, mape_variant: str = "a") -> Column:
    """a: 100-MAPE, b: the same not below 0, c/d/e: share within 20 %, f: 100(1-WAPE)."""
    return {
        "a": 100 - mape(mape_variant),
        "b": F.when(mape(mape_variant).isNotNull(), F.greatest(F.lit(0.0), 100 - mape(mape_variant))),
        "c": 100 * _per_row("hit_floor"),
        "d": 100 * _per_row("hit_abs"),
        "e": 100 * _per_row("hit_ratio"),
        "f": F.when(F.col("abs_y") == 0, F.when(F.col("abs_err") == 0, 100.0).otherwise(0.0)).otherwise(
            100 * (1 - F.try_divide(F.col("abs_err"), F.col("abs_y")))
        ),
    }[variant]


def coverage() -> Column:
    return 100 * _per_row("covered")


def avg_width() -> Column:
    return _per_row("width")


def residual_std() -> Column:
    """Sample deviation of the residuals; 0 for a single row."""
    return F.when(F.col("n") > 1, F.sqrt(F.try_divide(F.col("m2_err"), F.col("n") - 1))).otherwise(0.0)


def normal_band(df: DataFrame, sums: DataFrame, by: list[str], spread: Column,
                y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """``sums`` with ``covered`` and ``width`` of the band yhat +/- 1.96 * spread.

    The spread is known only after the first pass, so rows are read a second time and
    meet their group's one row of ``sums``; ``sums`` should be a materialized table so
    that the join is a broadcast whenever it is small enough.
    """
    half = sums.select(*by, (Z95 * spread).alias("__half"))
    t, p = F.col(y), F.col(yhat)
    inside = (t >= p - F.col("__half")) & (t <= p + F.col("__half"))
    covered = (
        join_null_safe(df, half, by)
        .groupBy(*by)
        .agg(F.count_if(inside).alias("covered"),
             F.sum((p + F.col("__half")) - (p - F.col("__half"))).alias("width"))
    )
    return join_null_safe(sums, covered, by)


def pinball(y: str, yhat: str, tau: float) -> Column:
    """Quantile loss of one row."""
    e = F.col(y) - F.col(yhat)
    return F.greatest(tau * e, (tau - 1) * e)
