"""Additive daily forecast: trend with bends, weekly and yearly waves, regressors.

After the published additive model (Taylor and Letham, 2018): the posterior mode, with
normal priors as squared penalties and the double-exponential prior of the trend's bends as
an absolute-value penalty, which leaves most bends at zero. Spark builds the design and adds
up the cross products of each family; one small solve per family remains.

The band is sampled: each draw lets the trend bend in the forecast days as often, and as
strongly on average, as it could in the training days, and adds noise.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.linear import cross_products
from panelcast.operators.windows import holdout_last
from panelcast.session import materialize, spread

# Number and range of trend bends, wave orders and periods, prior widths.
BENDS, BEND_RANGE = 25, 0.8
YEARLY, YEAR_DAYS = 10, 365.25
WEEKLY, WEEK_DAYS = 3, 7.0
BEND_PRIOR, WAVE_PRIOR, TREND_PRIOR = 0.05, 10.0, 5.0
# Number of draws and the shares between which the band lies.
DRAWS, BAND = 1000, (0.025, 0.975)
SEED = 7
EXOG = ["onpromotion", "is_holiday", "dcoilwtico"]
BINARY = ["is_holiday"]
KEY = ["family"]

# Position of each part in the design array.
PARTS = {
    "trend": (0, 2 + BENDS),
    "yearly": (2 + BENDS, 2 * YEARLY),
    "weekly": (2 + BENDS + 2 * YEARLY, 2 * WEEKLY),
    **{c: (2 + BENDS + 2 * YEARLY + 2 * WEEKLY + i, 1) for i, c in enumerate(EXOG)},
}
SIZE = 2 + BENDS + 2 * YEARLY + 2 * WEEKLY + len(EXOG)


IS_BEND = np.isin(np.arange(SIZE), np.arange(2, 2 + BENDS))


def penalties() -> np.ndarray:
    """Inverse prior variances; the bends have none, their prior is not normal."""
    lam = np.full(SIZE, 1.0 / WAVE_PRIOR**2)
    lam[:2] = 1.0 / TREND_PRIOR**2
    lam[IS_BEND] = 0.0
    return lam


def sparse_minimum(square: np.ndarray, linear: np.ndarray, weight: float) -> np.ndarray:
    """The ``b`` that minimises b'Sb/2 - r'b + weight * sum|b|.

    Signs are kept for the entries in use. With the signs fixed the minimum is a linear solve;
    the step towards it stops at the best of the points where an entry changes its sign, and
    an entry at zero comes into use when its slope exceeds the weight.
    """
    size = len(linear)
    b, sign = np.zeros(size), np.zeros(size)
    slack = 1e-9 * max(weight, float(np.abs(linear).max(initial=0.0)))

    def value(x: np.ndarray) -> float:
        return float(x @ square @ x / 2 - linear @ x + weight * np.abs(x).sum())

    for _ in range(50 * size):
        slope = square @ b - linear
        used = b != 0
        if not used.any() or np.abs(slope + weight * sign)[used].max() <= slack:
            outside = np.where(used, 0.0, np.abs(slope))
            j = int(outside.argmax())
            if outside[j] <= weight + slack:
                break
            sign[j] = -np.sign(slope[j])
        at = np.flatnonzero(sign)
        goal = np.zeros(size)
        goal[at] = np.linalg.lstsq(square[np.ix_(at, at)], linear[at] - weight * sign[at], rcond=None)[0]
        crossing = at[(b[at] != 0) & (np.sign(goal[at]) != np.sign(b[at]))]
        stops = [(b[k] / (b[k] - goal[k]), k) for k in crossing]
        tried = [(value(goal), 1.0, -1), *[(value(b + f * (goal - b)), f, k) for f, k in stops]]
        best, part, gone = min(tried)
        if best >= value(b):
            break
        b = b + part * (goal - b)
        if gone >= 0:
            b[gone] = 0.0
        sign = np.sign(b)
    return b


def scaling(train: DataFrame) -> DataFrame:
    """First day, span, target scale and regressor scales of each family's training days."""
    stats = [F.min("date").alias("day0"), F.greatest(F.datediff(F.max("date"), F.min("date")), F.lit(1)).alias("span"),
             F.max(F.abs("sales")).alias("y_scale")]
    for c in EXOG:
        stats += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")]
    return train.groupBy(*KEY).agg(*stats).withColumn(
        "y_scale", F.when(F.col("y_scale") > 0, F.col("y_scale")).otherwise(1.0)
    )


def design(df: DataFrame, scales: DataFrame) -> DataFrame:
    """Add the design array ``x`` and the scaled target ``z``."""
    t = F.datediff("date", "day0") / F.col("span")
    day = F.unix_date("date").cast("double")

    def waves(order: int, period: float) -> list[Column]:
        turns = [2.0 * math.pi * n / period * day for n in range(1, order + 1)]
        return [f(a) for a in turns for f in (F.sin, F.cos)]

    def regressor(c: str) -> Column:
        value = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        if c in BINARY:
            return value
        return (value - F.col(f"m_{c}")) / F.when(F.col(f"s_{c}") > 0, F.col(f"s_{c}")).otherwise(1.0)

    bends = [F.greatest(t - F.lit(BEND_RANGE * (j + 1) / (BENDS + 1)), F.lit(0.0)) for j in range(BENDS)]
    x = F.array(F.lit(1.0), t, *bends, *waves(YEARLY, YEAR_DAYS), *waves(WEEKLY, WEEK_DAYS),
                *[regressor(c) for c in EXOG])
    joined = df.join(scales, KEY)
    return joined.withColumns({"x": x, "z": F.col("sales") / F.col("y_scale")}).drop(
        "day0", "span", *[f"{k}_{c}" for c in EXOG for k in ("m", "s")]
    )


def posterior_mode(xx: np.ndarray, xz: np.ndarray, variance: float) -> np.ndarray:
    """Weights at a given noise variance: all but the bends are solved away, then put back."""
    a, c = xx / variance + np.diag(penalties()), xz / variance
    rest, bend = ~IS_BEND, IS_BEND
    inner = np.linalg.solve(a[np.ix_(rest, rest)], np.column_stack([a[np.ix_(rest, bend)], c[rest]]))
    beta = np.zeros(len(c))
    cross = a[np.ix_(bend, rest)]
    beta[bend] = sparse_minimum(a[np.ix_(bend, bend)] - cross @ inner[:, :-1], c[bend] - cross @ inner[:, -1], 1.0 / BEND_PRIOR)
    beta[rest] = inner[:, -1] - inner[:, :-1] @ beta[bend]
    return beta


def solve_family(rows: pd.DataFrame) -> pd.DataFrame:
    """Weights and residual deviation from one family's SIZE+1 matrix rows."""
    rows = rows.sort_values("i")
    m = np.stack(rows["values"].to_list())
    n = float(m[0, 0])  # the design starts with a constant 1
    xx, xz, zz = m[:-1, :-1], m[:-1, -1], m[-1, -1]
    variance = max(zz / n, 1e-12)
    for _ in range(200):
        beta = posterior_mode(xx, xz, variance)
        sse = max(float(zz - 2 * beta @ xz + beta @ xx @ beta), 0.0)
        updated = max(sse / n, 1e-12)
        if abs(updated - variance) <= 1e-9 * variance:
            break
        variance = updated
    return pd.DataFrame({"family": [rows["family"].iloc[0]], "beta": [beta.tolist()], "sigma": [math.sqrt(variance)]})


def fit(train: DataFrame, scales: DataFrame) -> DataFrame:
    """(family, beta, sigma) on the scaled target; SIZE+1 rows reach each solve."""
    rows = design(train, scales).select(*KEY, F.concat("x", F.array("z")).alias("x"))
    return spread(cross_products(rows, KEY, SIZE + 1), KEY).groupBy(*KEY).applyInPandas(
        solve_family, "family string, beta array<double>, sigma double"
    )


def dot(start: int, length: int) -> Column:
    products = F.zip_with(F.slice("x", start + 1, length), F.slice("beta", start + 1, length), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def components(df: DataFrame, scales: DataFrame, models: DataFrame) -> DataFrame:
    """What each part adds to the forecast on each day; the parts sum to ``yhat``.

    ``t`` is the day's place, 1 at the end of training; ``bend_size`` the mean size of a bend.
    """
    rows = design(df, scales).join(models, KEY)
    parts = {name: (dot(*where) * F.col("y_scale")) for name, where in PARTS.items()}
    table = rows.select(*KEY, "date", "sales", F.col("sigma"), F.col("y_scale"), F.col("x")[1].alias("t"),
                        F.aggregate(F.slice("beta", 3, BENDS), F.lit(0.0), lambda acc, v: acc + F.abs(v) / BENDS).alias("bend_size"),
                        *[c.alias(f"part_{n}") for n, c in parts.items()])
    total = sum((F.col(f"part_{n}") for n in PARTS), F.lit(0.0))
    return table.withColumn("yhat", total)


def optimality(train: DataFrame, scales: DataFrame, models: DataFrame) -> DataFrame:
    """(family, n_bends, excess): bends in use, and how far the slopes are from a minimum's.

    The slopes are summed over the training rows, not taken from the matrix of the fit. At the
    minimum they are 0 but for the bends: minus the penalty's sign where a bend is in use, at
    most the penalty where it is not. ``excess`` is the largest departure in shares of it.
    """
    off = F.col("z") - dot(0, SIZE)
    slopes = F.array(*[F.sum(-F.col("x")[j] * F.col("off")) for j in range(SIZE)])
    sums = design(train, scales).join(models, KEY).withColumn("off", off).groupBy(*KEY).agg(
        slopes.alias("slopes"), F.first("beta").alias("beta"), F.first("sigma").alias("sigma"))
    parts = []
    for j, penalty in enumerate(penalties().tolist()):
        beta = F.col("beta")[j]
        slope = (F.col("slopes")[j] / F.col("sigma") ** 2 + penalty * beta) * BEND_PRIOR
        if IS_BEND[j]:
            slope = F.when(beta != 0, slope + F.signum(beta)).otherwise(F.greatest(F.abs(slope) - 1.0, F.lit(0.0)))
        parts.append(F.abs(slope))
    used = F.size(F.filter(F.slice("beta", 3, BENDS), lambda v: v != 0))
    return sums.select(*KEY, used.alias("n_bends"), F.greatest(*parts).alias("excess"))


def draw_band(rows: pd.DataFrame) -> pd.DataFrame:
    """Lower and upper end of each forecast day of one family, from seeded draws.

    Bends come at the rate of the training days, BENDS in a span of 1, with
    double-exponential sizes. Each draw is taken with its mirror image, which is as likely, so
    the band is centred. A draw's trend is kept as running sums of sizes and of
    size x place, so memory is draws x days however many bends are drawn.
    """
    rows = rows.sort_values("date")
    first = rows.iloc[0]
    random = np.random.default_rng([SEED, zlib.crc32(str(first["family"]).encode())])
    t = rows["t"].to_numpy()
    ahead = max(float(t[-1]) - 1.0, 0.0)
    draws = DRAWS // 2
    owner = np.repeat(np.arange(draws), random.poisson(BENDS * ahead, draws))
    place = 1.0 + ahead * random.random(len(owner))
    size = random.laplace(0.0, first["bend_size"] + 1e-8, len(owner))
    day = np.searchsorted(t, place, side="right")
    seen = day < len(t)
    sums = np.zeros((2, draws, len(t)))
    for total, part in zip(sums, (size, size * place)):
        np.add.at(total, (owner[seen], day[seen]), part[seen])
    sums = sums.cumsum(axis=2)
    paths = t * sums[0] - sums[1] + random.normal(0.0, first["sigma"], (draws, len(t)))
    lower, upper = np.quantile(np.concatenate([paths, -paths]), BAND, axis=0) * first["y_scale"]
    yhat = rows["yhat"].to_numpy()
    return pd.DataFrame({"family": rows["family"], "date": rows["date"], "y_true": rows["sales"], "y_pred": yhat,
                         "lower": yhat + lower, "upper": yhat + upper})


def sampled_band(parts: DataFrame) -> DataFrame:
    """(family, date, y_true, y_pred, lower, upper); a group is one family's forecast days."""
    rows = parts.select(*KEY, "date", F.col("sales").cast("double").alias("sales"), "yhat", "t", "sigma", "y_scale", "bend_size")
    return spread(rows, KEY).groupBy(*KEY).applyInPandas(
        draw_band, "family string, date date, y_true double, y_pred double, lower double, upper double")


def split_and_fit(daily: DataFrame, horizon: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(training days, last ``horizon`` days, scales, models), the last two of the training days."""
    split = materialize(holdout_last(daily, horizon, KEY), "additive_series")
    train, test = split.where("not is_test"), split.where("is_test")
    scales = materialize(scaling(train), "additive_scales")
    return train, test, scales, materialize(fit(train, scales), "additive_models")


def additive_forecast(daily: DataFrame, horizon: int = 90) -> tuple[DataFrame, DataFrame]:
    """(forecast rows with a 95 % band, component rows) for the last ``horizon`` days."""
    _, test, scales, models = split_and_fit(daily, horizon)
    parts = components(test, scales, models)
    return sampled_band(parts), parts.drop("sigma", "y_scale", "sales", "t", "bend_size")
