"""Linear models per group from distributed moment sums.

Spark reduces each group to its centred moments (a handful of sums with map-side
partials, so a family with a third of the rows is no special case). What is left to
Python is one small solve per group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import clip_lower
from panelcast.operators.aggregates import daily_actual_vs_pred, distinct_cells, most_frequent
from panelcast.operators.features import (
    before_date,
    between_dates,
    null_columns,
    promo_scenarios,
    split_features,
)
from panelcast.operators.folds import Fold, assign_folds
from panelcast.operators.joins import in_segment
from panelcast.operators.quantiles import exact_quantile, exact_quantiles
from panelcast.session import materialize, spread

# Candidate features of the per-family models, penalties and cut-offs.
CANDIDATES = [
    "onpromotion", "promo_weekend", "promo_holiday", "is_weekend", "is_holiday", "day_of_week",
    "month", "dcoilwtico", "sales_lag_7", "sales_lag_14", "sales_lag_28", "rolling_mean_30",
    "transactions",
]
ALPHAS = (1.0, 0.1, 0.01, 0.001)
KEPT_ABOVE = 1e-8
RANK_CUT = 1e-10


def existing(df: DataFrame, candidates: list[str] = CANDIDATES) -> list[str]:
    return [c for c in candidates if c in df.columns]


# --- moments -----------------------------------------------------------------------------


def group_stats(df: DataFrame, by: list[str], features: list[str], y: str,
                impute: list[str] = ()) -> DataFrame:
    """Per group: row count, medians of the columns to impute, means after imputation."""
    medians = None
    if impute:
        medians = exact_quantile(df, by, list(impute), 0.5).select(
            *by, *[F.col(c).alias(f"__med_{c}") for c in impute]
        )
    base = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(y).alias("mean_y"),
        *[F.struct(F.count(c).alias("k"), F.avg(c).alias("m")).alias(f"__{c}") for c in features],
    )
    if medians is not None:
        base = base.join(medians, by, "left")

    def fill(c: str) -> Column:
        return F.coalesce(F.col(f"__med_{c}"), F.lit(0.0)) if c in impute else F.lit(0.0)

    def mean(c: str) -> Column:
        seen, average = F.col(f"__{c}.k"), F.coalesce(F.col(f"__{c}.m"), F.lit(0.0))
        return (average * seen + fill(c) * (F.col("n") - seen)) / F.col("n")

    return base.select(
        *by, "n", "mean_y",
        F.array(*[mean(c) for c in features]).alias("mean_x"),
        F.array(*[fill(c) for c in features]).alias("fill_x"),
    )


def filled(features: list[str]) -> list[Column]:
    """Feature values with the group's fill value in place of null."""
    return [F.coalesce(F.col(c).cast("double"), F.col("fill_x")[i]) for i, c in enumerate(features)]


def moments(df: DataFrame, stats: DataFrame, by: list[str], features: list[str], y: str,
            part: list[str] = ()) -> DataFrame:
    """Sums and sums of products of the centred features and target.

    ``total`` holds the k+1 sums, ``product`` the upper triangle row by row. With
    ``part`` they are split further (say, by validation fold) but keep the centre of the
    whole group, so parts add up and subtract.
    """
    size = len(features) + 1
    keys = [*by, *part]
    centred = [x - F.col("mean_x")[i] for i, x in enumerate(filled(features))]
    centred.append(F.col(y).cast("double") - F.col("mean_y"))
    joined = df.join(stats, by)
    if size > WIDE:
        rows = joined.select(*keys, F.array(F.lit(1.0), *centred).alias("x"))
        return packed(cross_products(rows, keys, size + 1), keys, size)
    z = [F.col(f"__z{i}") for i in range(size)]
    rows = joined.select(*keys, *[c.alias(f"__z{i}") for i, c in enumerate(centred)])
    products = [F.sum(z[i] * z[j]) for i in range(size) for j in range(i, size)]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.sum(c) for c in z]).alias("total"),
        F.array(*products).alias("product"),
    )


# Beyond this many columns a product per pair no longer fits one generated aggregate.
WIDE = 20


def cross_products(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(keys, i, values): row i of each group's matrix of products of the array ``x``.

    Each Arrow batch gives one partial matrix per group it holds; Spark adds them up,
    map side first.
    """
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, part in batch.groupby(keys, sort=False):
                m = np.stack(part["x"].to_list())
                out = pd.DataFrame({"i": range(size), "values": list(m.T @ m)})
                for c, v in zip(reversed(keys), reversed(key)):
                    out.insert(0, c, v)
                yield out

    parts = rows.select(*keys, "x").mapInPandas(partial, f"{types}, i int, values array<double>")
    return parts.groupBy(*keys, "i").agg(F.array(*[F.sum(F.col("values")[j]) for j in range(size)]).alias("values"))


def packed(matrix: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Moments of arrays that start with a constant 1, from their matrix rows."""
    lines = F.array_sort(F.collect_list(F.struct("i", "values")))
    upper = F.flatten(F.transform(F.slice("m", 2, size), lambda r: F.slice(r["values"], r["i"] + 1, size)))
    return matrix.groupBy(*keys).agg(lines.alias("m")).select(
        *keys,
        F.col("m")[0]["values"][0].cast("long").alias("rows"),
        F.slice(F.col("m")[0]["values"], 2, size).alias("total"),
        upper.alias("product"),
    )


def square(packed: np.ndarray, size: int) -> np.ndarray:
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = packed
    return full + np.triu(full, 1).T


def least_norm(sxx: np.ndarray, sxy: np.ndarray) -> np.ndarray:
    """Least-squares solution; of all solutions the shortest where columns are collinear."""
    scale = np.sqrt(np.diag(sxx))
    used = scale > 0
    beta = np.zeros(len(sxy))
    if not used.any():
        return beta
    s = scale[used]
    values, vectors = np.linalg.eigh(sxx[np.ix_(used, used)] / np.outer(s, s))
    keep = values > RANK_CUT * values[-1]
    solution = (vectors[:, keep] / values[keep]) @ (vectors[:, keep].T @ (sxy[used] / s)) / s
    null = vectors[:, ~keep] / s[:, None]
    if null.shape[1]:
        solution = solution - null @ np.linalg.lstsq(null, solution, rcond=None)[0]
    beta[used] = solution
    return beta


# --- ordinary least squares per group ----------------------------------------------------


def grouped_ols(df: DataFrame, by: list[str], features: list[str], y: str = "sales", min_n: int = 30,
                impute: list[str] | None = None) -> DataFrame:
    """Per group: n, mean_y, intercept, coefs, mean_x and fill_x (arrays in feature order).

    Groups below ``min_n`` rows are left out. ``impute`` names the columns that may be
    null (by default those that are); they take the group's exact median. Hand in a
    materialized table: it is read once per pass.
    """
    impute = null_columns(df, features) if impute is None else impute
    large = group_stats(df, by, features, y, [c for c in features if c in impute]).where(F.col("n") >= min_n)
    stats = materialize(large, "ols_stats")
    reduced = moments(df, stats, by, features, y).select(*by, "product").join(stats, by)
    size = len(features) + 1

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coefs, intercepts = [], []
            for product, mean_x, mean_y in zip(batch["product"], batch["mean_x"], batch["mean_y"]):
                m = square(np.asarray(product), size)
                beta = least_norm(m[:-1, :-1], m[:-1, -1])
                coefs.append(beta)
                intercepts.append(mean_y - float(np.dot(beta, mean_x)))
            yield batch.drop(columns="product").assign(coefs=coefs, intercept=intercepts)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields)
    return spread(reduced, by).mapInPandas(solve, f"{fields}, coefs array<double>, intercept double")


# Terms added up one after the other.
BLOCK = 64


def linear_prediction(features: list[str]) -> Column:
    """intercept + sum of coef * value, added up in blocks so that a wide sum is not a deep one."""
    terms = [F.col("intercept"), *[F.col("coefs")[i] * value for i, value in enumerate(filled(features))]]
    while len(terms) > 1:
        terms = [reduce(Column.__add__, terms[k:k + BLOCK]) for k in range(0, len(terms), BLOCK)]
    return terms[0]


def predict(df: DataFrame, models: DataFrame, by: list[str], features: list[str], name: str = "y_pred") -> DataFrame:
    """Score rows with their group's model; rows of groups without a model drop out."""
    table = models.select(*by, "intercept", "coefs", "fill_x")
    return df.join(table, by).withColumn(name, linear_prediction(features)).drop("intercept", "coefs", "fill_x")


def coefficient_table(models: DataFrame, by: list[str], features: list[str]) -> DataFrame:
    """Coefficients in long form."""
    rows = [F.struct(F.lit(c).alias("feature"), F.col("coefs")[i].alias("coef")) for i, c in enumerate(features)]
    return models.select(*by, F.explode(F.array(*rows)).alias("c")).select(*by, "c.*")


def promotion_effect(models: DataFrame, segments: DataFrame, features: list[str]) -> DataFrame:
    """Promotion coefficients and mean sale by family; a missing term counts 0."""
    def coef(c: str) -> Column:
        return F.col("coefs")[features.index(c)] if c in features else F.lit(0.0)

    table = models.select(
        "family", coef("onpromotion").alias("coef_promo"), coef("promo_weekend").alias("coef_promo_weekend"),
        coef("promo_holiday").alias("coef_promo_holiday"), F.col("mean_y").alias("mean_sale"),
    )
    return table.join(segments.select("family", "segment"), "family")


# --- one model for all families ----------------------------------------------------------


def linear_oof(df: DataFrame, folds: list[Fold], segments: DataFrame, names: list[str] = ("High", "Medium"),
               y: str = "sales", keys: list[str] = ("date", "store_nbr", "family")) -> DataFrame:
    """Linear model on all families of each fold's training rows, scored on the named segments.

    Numbers take the median and text the most frequent value of the training rows; text
    is one-hot, a value unseen in training being all zero. All folds are fitted by the
    same passes. Hand in a materialized table.
    """
    numeric, text = split_features(df, [*keys, y])
    gaps = null_columns(df, [*numeric, *text])
    rows = assign_folds(df, folds)
    train, test = rows.where("split = 'train'"), in_segment(rows.where("split = 'test'"), segments, list(names))

    known = distinct_cells(train, text).collect() if text else []
    flags = [(f"{r['feature']}={r['value']}", r["feature"], r["value"]) for r in sorted(known)]
    holes = [c for c in text if c in gaps]
    modes = materialize(most_frequent(train, holes, ["fold"]).groupBy("fold").pivot("feature", holes).agg(
        F.first("value")).select("fold", *[F.col(c).alias(f"__mode_{c}") for c in holes]), "modes") if holes else None

    def encoded(part: DataFrame) -> DataFrame:
        if modes is not None:
            part = part.join(modes, "fold", "left").withColumns(
                {c: F.coalesce(F.col(c), F.col(f"__mode_{c}")) for c in holes})
        return part.withColumns({name: F.when(F.col(c) == v, 1.0).otherwise(0.0) for name, c, v in flags})

    features = [*numeric, *[name for name, _, _ in flags]]
    models = grouped_ols(encoded(train), ["fold"], features, y, min_n=1, impute=[c for c in numeric if c in gaps])
    scored = predict(encoded(test), materialize(models, "linear_models"), ["fold"], features)
    return scored.select(*keys, "fold", F.col(y).alias("y_true"), "y_pred")


# --- what-if and baseline ----------------------------------------------------------------


def promo_what_if(df: DataFrame, features: list[str], lo: str, hi: str, y: str = "sales",
                  impute: list[str] | None = None) -> DataFrame:
    """Models fitted before ``lo``, the period scored with promotion everywhere and nowhere.

    (date, store_nbr, family, sales_pred, scenario) for all families at once.
    """
    train = before_date(df, lo)
    models = materialize(grouped_ols(train, ["family"], features, y, min_n=1, impute=impute), "what_if_models")
    scenarios = promo_scenarios(between_dates(df, lo, hi))
    scored = predict(scenarios, models, ["family"], features, "sales_pred")
    return scored.select("date", "store_nbr", "family", "sales_pred", "scenario")


def baseline_vs_actual(df: DataFrame, features: list[str], lo: str, hi: str, y: str = "sales",
                       min_train: int = 50, impute: list[str] | None = None) -> DataFrame:
    """Daily actual sales against the no-promotion baseline, by family."""
    train = before_date(df, lo)
    models = materialize(grouped_ols(train, ["family"], features, y, min_n=min_train, impute=impute), "baseline_models")
    period = between_dates(df, lo, hi).withColumn("__promo", F.col("onpromotion"))
    baseline = promo_scenarios(period).where("scenario = 'no_promo'")
    scored = predict(baseline, models, ["family"], features, "baseline")
    return daily_actual_vs_pred(scored, ["family"], y, "baseline", "__promo")


# --- Lasso per group ---------------------------------------------------------------------


def contiguous_folds(df: DataFrame, by: list[str], folds: int = 5, date: str = "date",
                     tie: list[str] = ("store_nbr",)) -> DataFrame:
    """Column ``cv``: which of the contiguous fifths of its group a row falls in.

    Rows are ordered by (date, tie). Their positions come from counts per day, so a
    group is never sorted as a whole; only the days that a fold border cuts through are
    ranked row by row.
    """
    daily = df.groupBy(*by, date).agg(F.count(F.lit(1)).alias("__d"))
    before = Window.partitionBy(*by).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    placed = daily.select(
        *by, date, "__d",
        F.coalesce(F.sum("__d").over(before), F.lit(0)).alias("__start"),
        F.sum("__d").over(Window.partitionBy(*by)).alias("__n"),
    )
    short = F.floor(F.col("__n") / folds)
    longer = F.col("__n") - short * folds
    border = longer * (short + 1)

    def fold_at(position: Column) -> Column:
        late = longer + F.floor(F.try_divide(position - border, short))
        return F.when(position < border, F.floor(position / (short + 1))).otherwise(late).cast("int")

    starts = materialize(
        placed.withColumns({
            "__first": fold_at(F.col("__start")),
            "__last": fold_at(F.col("__start") + F.col("__d") - 1),
        }),
        "fold_days",
    )
    rows = df.join(starts, [*by, date])
    whole = rows.where("__first = __last").withColumn("cv", F.col("__first"))
    within = Window.partitionBy(*by, date).orderBy(*tie)
    cut = rows.where("__first <> __last").withColumn("__r", F.row_number().over(within) - 1)
    cut = cut.withColumn("cv", fold_at(F.col("__start") + F.col("__r"))).drop("__r")
    return whole.unionByName(cut).drop("__d", "__start", "__n", "__first", "__last")


def descend(gram: np.ndarray, target: np.ndarray, alpha: float, start: np.ndarray,
            sweeps: int = 10_000, tol: float = 1e-9) -> np.ndarray:
    """Coordinate descent on the Gram matrix of 1/2 |y-Xw|^2/n + alpha |w|."""
    w = start.copy()
    fitted = gram @ w
    limit = tol * max(1.0, float(np.abs(target).max(initial=0.0)))
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(w)):
            if gram[j, j] <= 0:
                continue
            rho = target[j] - fitted[j] + gram[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / gram[j, j]
            if new != w[j]:
                fitted += gram[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * gram[j, j])
                w[j] = new
        if moved < limit:
            break
    return w


def lasso_from_parts(rows: np.ndarray, totals: np.ndarray, products: np.ndarray,
                     alphas: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray, float]:
    """(scaled coefs, scale, chosen alpha) of one group from its moments per fold.

    Features are scaled by the whole group; each training set is centred by itself. A
    training set is the total less one fold, and the error on the fold left out needs
    only that fold's moments.
    """
    k = totals.shape[1] - 1
    n = rows.sum()
    total, product = totals.sum(axis=0), products.sum(axis=0)
    centred = product - np.outer(total, total) / n
    scale = np.sqrt(np.maximum(np.diag(centred)[:k] / n, 0.0))
    scale[scale == 0] = 1.0
    unit = np.append(scale, 1.0)

    def path(count: float, sums: np.ndarray, prods: np.ndarray) -> list[np.ndarray]:
        c = (prods - np.outer(sums, sums) / count) / np.outer(unit, unit) / count
        w, found = np.zeros(k), []
        for alpha in alphas:
            w = descend(c[:k, :k], c[:k, k], alpha, w)
            found.append(w)
        return found

    errors = np.zeros(len(alphas))
    used = 0
    for f in range(len(rows)):
        count = n - rows[f]
        if rows[f] == 0 or count == 0:
            continue
        used += 1
        sums, prods = total - totals[f], product - products[f]
        centre = sums / count
        held = (
            products[f] - np.outer(totals[f], centre) - np.outer(centre, totals[f])
            + rows[f] * np.outer(centre, centre)
        ) / np.outer(unit, unit)
        for a, w in enumerate(path(count, sums, prods)):
            v = np.append(-w, 1.0)
            errors[a] += float(v @ held @ v) / rows[f]
    best = int(np.argmin(errors)) if used else 0
    return path(n, total, product)[best], scale, alphas[best]


def grouped_lasso(df: DataFrame, by: list[str], features: list[str], y: str = "sales",
                  alphas: tuple[float, ...] = ALPHAS, folds: int = 5, min_n: int = 30,
                  impute: list[str] | None = None) -> DataFrame:
    """Kept features per group: (by, feature, coef_scaled, coef, alpha).

    One shuffle of moments by (group, fold) serves all penalties and the final fit.
    """
    impute = null_columns(df, features) if impute is None else impute
    large = group_stats(df, by, features, y, [c for c in features if c in impute]).where(F.col("n") >= min_n)
    stats = materialize(large, "lasso_stats")
    parts = moments(contiguous_folds(df, by, folds), stats, by, features, y, ["cv"])
    size = len(features) + 1
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cv")
        products = np.stack([square(np.asarray(p), size) for p in group["product"]])
        scaled, scale, alpha = lasso_from_parts(
            group["rows"].to_numpy(float), np.stack(group["total"].to_list()), products, alphas
        )
        out = pd.DataFrame({"feature": features, "coef_scaled": scaled, "coef": scaled / scale, "alpha": alpha})
        for c in reversed(by):
            out.insert(0, c, group[c].iloc[0])
        return out[out["coef"].abs() > KEPT_ABOVE]

    # One row per fold and group reaches the function.
    return spread(parts, by).groupBy(*by).applyInPandas(
        fit, f"{schema}, feature string, coef_scaled double, coef double, alpha double"
    )


# --- quantile forecast -------------------------------------------------------------------


def residual_quantiles(train: DataFrame, by: list[str], y: str, yhat: str, taus: dict[str, float]) -> DataFrame:
    """Exact quantiles of the training residuals per group."""
    residuals = materialize(train.select(*by, (F.col(y) - F.col(yhat)).alias("__e")), "residuals")
    return exact_quantiles(residuals, by, {name: ("__e", tau) for name, tau in taus.items()})


# The levels of the quantile forecast.
TAUS = {"q05": 0.05, "q50": 0.5, "q95": 0.95}


def add_quantiles(df: DataFrame, offsets: DataFrame, by: list[str], yhat: str,
                  names: list[str] = tuple(TAUS)) -> DataFrame:
    """Prediction plus residual quantile, never negative, never crossing."""
    table = offsets.select(*by, *[F.col(c).alias(f"__o_{c}") for c in names])
    joined = df.join(materialize(table, "offsets"), by)
    previous = None
    for c in names:
        value = clip_lower(F.col(yhat) + F.col(f"__o_{c}"))
        joined = joined.withColumn(c, value if previous is None else F.greatest(value, F.col(previous)))
        previous = c
    return joined.drop(*[f"__o_{c}" for c in names])


def quantile_forecast(train: DataFrame, test: DataFrame, by: list[str], features: list[str], y: str = "sales") -> DataFrame:
    """q05, q50 and q95 for the test rows from a fitted centre and its residuals."""
    models = materialize(grouped_ols(train, by, features, y, min_n=1, impute=[]), "centre_models")
    centre = predict(train, models, by, features, "__centre")
    offsets = residual_quantiles(centre, by, y, "__centre", TAUS)
    return add_quantiles(predict(test, models, by, features, "__centre"), offsets, by, "__centre").drop("__centre")
