"""Seasonal autoregression with regressors, one model per daily family series.

Two rounds of least squares (Hannan and Rissanen, 1982): a long autoregression gives
the shocks, then lags of the differenced series and of the shocks are regressed
together. One set of moments per family holds all candidate orders, because a smaller
model is a sub-matrix of the largest one. The series are family-by-day rollups, so their
length is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.linear import group_stats, grouped_ols, least_norm, moments, predict, square
from panelcast.operators.windows import holdout_last
from panelcast.session import materialize, spread

# Season length, largest orders, default order, regressors, band quantile.
SEASON = 7
MAX_P, MAX_Q, MAX_SP, MAX_SQ = 3, 3, 2, 2
DEFAULT_ORDER, DEFAULT_SEASONAL = (1, 1, 1), (0, 1, 1, 7)
EXOG = ["onpromotion", "is_holiday", "dcoilwtico"]
Z95 = 1.96

LONG_LAGS = [1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 21]
AR = [f"w_{k}" for k in range(1, MAX_P + 1)]
SAR = [f"w_{SEASON * k}" for k in range(1, MAX_SP + 1)]
MA = [f"e_{k}" for k in range(1, MAX_Q + 1)]
SMA = [f"e_{SEASON * k}" for k in range(1, MAX_SQ + 1)]
DX = [f"dx_{c}" for c in EXOG]
FULL = [*AR, *SAR, *MA, *SMA, *DX]
MIN_ROWS = 80
KEY = ["family"]


def difference(value: str, d: Column, sd: Column, w) -> Column:
    """(1-B)^d (1-B^7)^D of a column, null until enough rows are behind it."""
    now, day, week, both = F.col(value), F.lag(value, 1).over(w), F.lag(value, SEASON).over(w), F.lag(value, SEASON + 1).over(w)
    return (
        F.when((d == 0) & (sd == 0), now)
        .when((d == 1) & (sd == 0), now - day)
        .when((d == 0) & (sd == 1), now - week)
        .otherwise(now - day - week + both)
    )


def choose_differences(train: DataFrame) -> DataFrame:
    """(family, d, D, status): the differences that leave the smallest variance.

    A series too short to estimate anything takes the default differences.
    """
    w = Window.partitionBy(*KEY).orderBy("date")
    lags = train.select(*KEY, F.col("sales").alias("y"), F.lag("sales", 1).over(w).alias("y1"),
                        F.lag("sales", SEASON).over(w).alias("y7"), F.lag("sales", SEASON + 1).over(w).alias("y8"))
    y, y1, y7, y8 = (F.col(c) for c in ("y", "y1", "y7", "y8"))
    series = {(0, 0): y, (1, 0): y - y1, (0, 1): y - y7, (1, 1): y - y1 - y7 + y8}
    spread = lags.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.var_pop(c).alias(f"v{d}{sd}") for (d, sd), c in series.items()],
    )
    least = F.least(*[F.col(f"v{d}{sd}") for d, sd in series])
    d = F.when(F.col("v00") == least, 0).when(F.col("v10") == least, 1).when(F.col("v01") == least, 0).otherwise(1)
    sd = F.when(F.col("v00") == least, 0).when(F.col("v10") == least, 0).otherwise(1)
    short = F.col("n") < MIN_ROWS
    return spread.select(
        *KEY,
        F.when(short, DEFAULT_ORDER[1]).otherwise(d).alias("d"),
        F.when(short, DEFAULT_SEASONAL[1]).otherwise(sd).alias("sd"),
        F.when(short, "default").otherwise("fitted").alias("status"),
    )


def prepare(daily: DataFrame, horizon: int) -> DataFrame:
    """Differenced series and regressors with all lags, shocks of the long autoregression."""
    w = Window.partitionBy(*KEY).orderBy("date")
    split = materialize(holdout_last(daily, horizon, KEY), "arx_series")
    choice = materialize(choose_differences(split.where("not is_test")), "arx_differences")
    joined = split.join(choice, KEY)
    d, sd = F.col("d"), F.col("sd")
    base = joined.select(
        *KEY, "date", "is_test", "sales", "d", "sd", "status",
        difference("sales", d, sd, w).alias("w"),
        *[difference(c, d, sd, w).cast("double").alias(f"dx_{c}") for c in EXOG],
    )
    lagged = sorted({*LONG_LAGS, *range(1, MAX_P + 1), *(SEASON * k for k in range(1, MAX_SP + 1))})
    base = materialize(base.select("*", *[F.lag("w", k).over(w).alias(f"w_{k}") for k in lagged]), "arx_lags")

    long_features = [*[f"w_{k}" for k in LONG_LAGS], *DX]
    usable = base.where("not is_test").na.drop(subset=["w", *long_features])
    long_fit = materialize(grouped_ols(usable, KEY, long_features, "w", min_n=len(long_features) + 2, impute=[]), "arx_long")
    shocks = predict(usable, long_fit, KEY, long_features, "__fit").select(
        *KEY, "date", (F.col("w") - F.col("__fit")).alias("e")
    )
    # A family without a long fit has no shocks; its lags are null and count as 0.
    full = base.join(shocks, [*KEY, "date"], "left")
    shock_lags = sorted({*range(1, MAX_Q + 1), *(SEASON * k for k in range(1, MAX_SQ + 1))})
    return materialize(full.select("*", *[F.lag("e", k).over(w).alias(f"e_{k}") for k in shock_lags]), "arx_design")


def stable(ar: np.ndarray, seasonal: np.ndarray) -> bool:
    """Whether the autoregressive part forgets its past."""
    lags = {i + 1: v for i, v in enumerate(ar)}
    for j, v in enumerate(seasonal):
        lags[SEASON * (j + 1)] = lags.get(SEASON * (j + 1), 0.0) + v
    if not lags:
        return True
    poly = np.zeros(max(lags) + 1)
    poly[0] = 1.0
    for lag, v in lags.items():
        poly[lag] -= v
    roots = np.roots(poly)
    return bool(len(roots) == 0 or np.abs(roots).max() < 0.999)


def candidates(design: DataFrame) -> DataFrame:
    """All orders per family with AIC, coefficients (full length, 0 where unused) and sigma."""
    usable = design.where("not is_test").na.drop(subset=["w", *FULL])
    stats = materialize(group_stats(usable, KEY, FULL, "w"), "arx_stats")
    reduced = moments(usable, stats, KEY, FULL, "w").select(*KEY, "rows", "product").join(stats, KEY)
    size = len(FULL) + 1

    def chosen(p: int, q: int, sp: int, sq: int) -> list[int]:
        names = [*AR[:p], *SAR[:sp], *MA[:q], *SMA[:sq], *DX]
        return [FULL.index(c) for c in names]

    orders = [(p, q, sp, sq) for p, q, sp, sq in product(
        range(MAX_P + 1), range(MAX_Q + 1), range(MAX_SP + 1), range(MAX_SQ + 1))]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for family, n, packed, mean_x, mean_y in zip(
                batch["family"], batch["rows"], batch["product"], batch["mean_x"], batch["mean_y"]
            ):
                m = square(np.asarray(packed), size)
                for p, q, sp, sq in orders:
                    cols = chosen(p, q, sp, sq)
                    beta = least_norm(m[np.ix_(cols, cols)], m[cols, -1])
                    sse = max(float(m[-1, -1] - beta @ m[cols, -1]), 1e-9 * max(float(m[-1, -1]), 1e-9))
                    full = np.zeros(len(FULL))
                    full[cols] = beta
                    k = len(cols) + 1
                    aic = float(n) * np.log(sse / n) + 2.0 * k
                    ok = n > k + 1 and stable(full[:MAX_P], full[MAX_P:MAX_P + MAX_SP])
                    out.append((family, p, q, sp, sq, float(aic) if ok else None, full.tolist(),
                                float(mean_y - full @ mean_x), float(np.sqrt(sse / max(n - k, 1)))))
            yield pd.DataFrame(out, columns=["family", "p", "q", "sp", "sq", "aic", "coefs", "intercept", "sigma"])

    return spread(reduced, KEY).mapInPandas(
        fit, "family string, p int, q int, sp int, sq int, aic double, coefs array<double>, intercept double, sigma double"
    )


def best_orders(table: DataFrame) -> DataFrame:
    """The usable order with the smallest AIC per family; ties go to the smaller order."""
    rank = F.struct("aic", (F.col("p") + F.col("q") + F.col("sp") + F.col("sq")).alias("terms"), "p", "q", "sp", "sq")
    best = table.where("aic is not null").groupBy(*KEY).agg(
        F.min_by(F.struct("p", "q", "sp", "sq", "aic", "coefs", "intercept", "sigma"), rank).alias("b")
    )
    return best.select(*KEY, "b.*")


def psi_weights(coefs: np.ndarray, d: int, sd: int, horizon: int) -> np.ndarray:
    """Weights of past shocks in the undifferenced series."""
    ar = np.zeros(SEASON * MAX_SP + 1)
    ma = np.zeros(SEASON * MAX_SQ + 1)
    ar[0] = ma[0] = 1.0
    for i in range(MAX_P):
        ar[i + 1] -= coefs[i]
    for j in range(MAX_SP):
        ar[SEASON * (j + 1)] -= coefs[MAX_P + j]
    at = MAX_P + MAX_SP
    for i in range(MAX_Q):
        ma[i + 1] += coefs[at + i]
    for j in range(MAX_SQ):
        ma[SEASON * (j + 1)] += coefs[at + MAX_Q + j]
    for _ in range(d):
        ar = np.convolve(ar, [1.0, -1.0])
    for _ in range(sd):
        ar = np.convolve(ar, [1.0, *[0.0] * (SEASON - 1), -1.0])
    psi = np.zeros(horizon)
    for h in range(horizon):
        psi[h] = ma[h] if h < len(ma) else 0.0
        for i in range(1, min(h, len(ar) - 1) + 1):
            psi[h] -= ar[i] * psi[h - i]
    return psi


def forecast_family(rows: pd.DataFrame) -> pd.DataFrame:
    """Run one family's recursion over its horizon from the rows just before it."""
    rows = rows.sort_values("date").reset_index(drop=True)
    first = int(rows["is_test"].to_numpy().argmax())
    horizon = len(rows) - first
    d, sd, sigma = int(rows["d"].iloc[0]), int(rows["sd"].iloc[0]), float(rows["sigma"].iloc[0])
    coefs, intercept = np.asarray(rows["coefs"].iloc[0], dtype=float), float(rows["intercept"].iloc[0])
    y = rows["sales"].to_numpy(float).copy()
    w = np.nan_to_num(rows["w"].to_numpy(float).copy())
    e = np.nan_to_num(rows["e"].to_numpy(float).copy())
    e[first:] = 0.0
    x = np.nan_to_num(rows[DX].to_numpy(float))
    lags = [*range(1, MAX_P + 1), *(SEASON * k for k in range(1, MAX_SP + 1))]
    shocks = [*range(1, MAX_Q + 1), *(SEASON * k for k in range(1, MAX_SQ + 1))]
    for t in range(first, len(rows)):
        past = [w[t - k] if t >= k else 0.0 for k in lags] + [e[t - k] if t >= k else 0.0 for k in shocks]
        w[t] = intercept + float(coefs @ np.concatenate([past, x[t]]))
        y[t] = w[t] + d * y[t - 1] + sd * y[t - SEASON] - d * sd * y[t - SEASON - 1]
    half = Z95 * sigma * np.sqrt(np.cumsum(psi_weights(coefs, d, sd, horizon) ** 2))
    pred = y[first:]
    test = rows.iloc[first:]
    return pd.DataFrame({
        "family": test["family"], "date": test["date"], "y_true": test["sales"],
        "y_pred": np.maximum(pred, 0.0), "lower": np.maximum(pred - half, 0.0), "upper": pred + half,
    })


def order_text(*parts: Column | str) -> Column:
    """(1, 0, 2) as text."""
    cells = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat(F.lit("("), F.concat_ws(", ", *[c.cast("string") for c in cells]), F.lit(")"))


def default_orders(design: DataFrame, best: DataFrame) -> DataFrame:
    """The default order's terms for families that no candidate serves, on the rows there are.

    Shocks that a short series has not are 0. A family with too few rows even for these terms
    has no coefficients, and the spread of its differenced series.
    """
    rows = design.join(best.select(*KEY), KEY, "left_anti").where("not is_test and w is not null")
    terms = [AR[0], MA[0], SMA[0], *DX]
    usable = rows.na.drop(subset=[AR[0]]).na.fill(0.0, subset=[*terms, *DX])
    fit = materialize(grouped_ols(usable, KEY, terms, "w", min_n=len(terms) + 2, impute=[]), "arx_default")
    error = F.col("w") - F.col("__fit")
    spread = predict(usable, fit, KEY, terms, "__fit").groupBy(*KEY).agg(
        F.sqrt(F.sum(error * error) / F.greatest(F.count(error) - len(terms) - 1, F.lit(1))).alias("sigma"))
    own = {c: F.col("coefs")[i] for i, c in enumerate(terms)}
    # An autoregressive part that does not forget its past would run away.
    own[AR[0]] = F.greatest(F.least(own[AR[0]], F.lit(0.99)), F.lit(-0.99))
    fitted = fit.join(spread, KEY).select(
        *KEY, F.array(*[own.get(c, F.lit(0.0)) for c in FULL]).alias("coefs"), "intercept", "sigma")
    alone = rows.groupBy(*KEY).agg(F.coalesce(F.stddev_pop("w"), F.lit(0.0)).alias("spread"))
    return alone.join(fitted, KEY, "left").select(
        *KEY, F.when(F.col("coefs").isNull(), "no terms").otherwise("default").alias("kind"),
        F.coalesce("coefs", F.array(*[F.lit(0.0)] * len(FULL))).alias("default_coefs"),
        F.coalesce("intercept", F.lit(0.0)).alias("default_intercept"),
        F.coalesce("sigma", "spread").alias("default_sigma"))


def seasonal_arx(daily: DataFrame, horizon: int = 90) -> tuple[DataFrame, DataFrame]:
    """(forecast rows with a 95 % band, orders per family with a status).

    ``daily`` has one row per family and day. Families with ``horizon`` days or fewer
    are left out. Status: fitted (the reported order is the best candidate), default (the
    default order's terms were fitted), no terms (the default differences alone).
    """
    design = prepare(daily, horizon)
    best = materialize(best_orders(candidates(design)), "arx_best")
    spare = materialize(default_orders(design, best), "arx_spare")
    plan = design.select(*KEY, "d", "sd").distinct().join(best, KEY, "left").join(spare, KEY, "left")
    served = F.col("coefs").isNotNull()
    plan = materialize(plan.select(
        *KEY, "p", "q", "sp", "sq", "aic",
        "d", "sd",
        F.when(served, "fitted").otherwise(F.coalesce("kind", F.lit("no terms"))).alias("status"),
        F.coalesce("coefs", "default_coefs", F.array(*[F.lit(0.0)] * len(FULL))).alias("coefs"),
        F.coalesce("intercept", "default_intercept", F.lit(0.0)).alias("intercept"),
        F.coalesce("sigma", "default_sigma", F.lit(0.0)).alias("sigma")), "arx_plan")
    orders = plan.select(
        *KEY, "status",
        order_text(F.coalesce("p", F.lit(DEFAULT_ORDER[0])), "d", F.coalesce("q", F.lit(DEFAULT_ORDER[2]))).alias("Order"),
        order_text(F.coalesce("sp", F.lit(DEFAULT_SEASONAL[0])), "sd", F.coalesce("sq", F.lit(DEFAULT_SEASONAL[2])),
                   F.lit(SEASON)).alias("Seasonal_Order"),
    )
    # The recursion needs only the rows its longest lag reaches back to.
    reach = horizon + SEASON * MAX_SP + SEASON + 2
    newest = Window.partitionBy(*KEY).orderBy(F.desc("date"))
    tail = design.withColumn("__r", F.row_number().over(newest)).where(F.col("__r") <= reach)
    rows = tail.select(*KEY, "date", "is_test", "sales", "w", "e", *DX).join(
        plan.select(*KEY, "d", "sd", "coefs", "intercept", "sigma"), KEY
    )
    forecast = spread(rows, KEY).groupBy(*KEY).applyInPandas(
        forecast_family, "family string, date date, y_true double, y_pred double, lower double, upper double"
    )
    return forecast, orders
