"""Forests and boosted trees on the panel, with MLlib doing the fitting.

Each training set is encoded once and written, because a tree learner reads it many
times; folds are fitted one after the other, each fit spread over the cluster.
"""

from __future__ import annotations

import datetime as dt

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import clip_lower, unlog
from panelcast.operators.aggregates import family_weights
from panelcast.operators.encode import apply_label, fit_label, fit_ordinal
from panelcast.operators.features import features_of, fill_constants, split_features, year_weight
from panelcast.operators.folds import Fold, assign_folds, test_rows, train_rows, validation_cut
from panelcast.operators.joins import in_families, in_segment, map_weight
from panelcast.operators.quantiles import clip_outliers
from panelcast.session import materialize

# The features of each model.
MEDIUM_FEATURES = [
    "store_nbr", "family", "onpromotion", "transactions", "city", "state", "type", "cluster",
    "dcoilwtico", "is_holiday", "day_of_week", "month", "year", "is_weekend", "sales_lag_7",
    "sales_lag_14", "rolling_mean_30",
]
MEDIUM_TEXT = ["family", "city", "state", "type"]
CORE_FEATURES = [
    "store_nbr", "family", "onpromotion", "transactions", "city", "state", "type", "cluster",
    "dcoilwtico", "is_holiday", "day_of_week", "week_of_year", "month", "year", "is_weekend",
    "sales_lag_7", "sales_lag_14", "rolling_mean_30",
]
HURDLE_FEATURES = [
    "store_nbr", "family", "city", "state", "type", "cluster", "dcoilwtico", "is_holiday",
    "day_of_week", "week_of_year", "month", "year", "is_weekend",
]
ENCODED = [
    "store_nbr", "family", "city", "state", "type", "cluster", "is_holiday", "day_of_week",
    "month", "year", "is_weekend",
]
KEY = ["date", "store_nbr", "family"]
# Names of the key columns kept as they were while the features are encoded.
IDS = ["id_date", "id_store_nbr", "id_family"]


def with_ids(df: DataFrame) -> DataFrame:
    return df.withColumns({i: F.col(k) for i, k in zip(IDS, KEY)})


def predictions(scored: DataFrame, fold: int, yhat: Column, y: str = "sales") -> DataFrame:
    """(date, store_nbr, family, fold, y_true, y_pred) of a scored, encoded frame."""
    return scored.select(*[F.col(i).alias(k) for i, k in zip(IDS, KEY)], F.lit(fold).alias("fold"),
                         F.col(y).alias("y_true"), yhat.alias("y_pred"))


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def importance(model, features: list[str], spark) -> DataFrame:
    """(Feature, Importance), most important first."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "Feature string, Importance double").orderBy(F.desc("Importance"), "Feature")


# Rounds without a better validation loss after which boosting counts as done.
PATIENCE = 100


def best_round(losses: list[float], patience: int = PATIENCE) -> int:
    """Rounds up to the lowest loss that is reached before ``patience`` rounds pass without a lower one."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The boosted model as it was after ``n`` rounds."""
    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(jvm.double, n)
    grown = model._java_obj.trees()
    for k in range(n):
        trees[k], weights[k] = grown[k], model.treeWeights[k]
    cut = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(model.uid, trees, weights))
    return cut.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def fit_rounds(boost: GBTRegressor, train: DataFrame, late: DataFrame | None, patience: int = PATIENCE) -> GBTRegressionModel:
    """Fit on ``train`` and keep the rounds that serve the rows of ``late`` best (none: all rounds)."""
    model = boost.fit(train)
    if late is None:
        return model
    return first_trees(model, best_round(model.evaluateEachIteration(late, boost.getLossType()), patience))


def fit_with_validation(boost: GBTRegressor, train: DataFrame, features: list[str], date: str = "date",
                        patience: int = PATIENCE) -> PipelineModel:
    """Fit before the last 30 training days and keep the rounds that serve those days best.

    Where they hold too few rows, nothing validates and all rounds stay.
    """
    vectors = assembler(features)
    keep = ["features", boost.getLabelCol(), "is_validation", *([boost.getWeightCol()] if boost.isSet("weightCol") else [])]
    marked = materialize(vectors.transform(validation_cut(train, 30, date=date)).select(*keep), "boosted_train")
    late = marked.where("is_validation")
    model = fit_rounds(boost, marked.where("not is_validation"), late if late.limit(1).count() else None, patience)
    return PipelineModel(stages=[vectors, model])


def cut_date(daily: dict[dt.date, int], fold: Fold, days: int = 30, min_rows: int = 50) -> dt.date | None:
    """Day after which a fold's training rows validate, by the rule of ``validation_cut``."""
    first, last = (dt.date.fromisoformat(str(d)) for d in fold[1:3])
    inside = {d: n for d, n in daily.items() if d is not None and first <= d <= last}
    if not inside:
        return None
    cut = max(inside) - dt.timedelta(days=days)
    late = sum(n for d, n in inside.items() if d > cut)
    return cut if late >= min_rows and late < sum(inside.values()) else None


# --- medium segment ----------------------------------------------------------------------


def prepare_medium(df: DataFrame, segments: DataFrame, fold: Fold, weights: dict[int, float],
                   segment: str = "Medium") -> tuple[DataFrame, DataFrame]:
    """Encoded (train, test) of one segment and fold.

    Nulls become 0, the training target is capped at its 0.99 quantile, and text is coded
    over the values of train and test together.
    """
    part = with_ids(in_segment(df, segments, [segment]))
    part = fill_constants(part, 0, "0")
    train = materialize(train_rows(part, fold), "medium_train")
    test = materialize(test_rows(part, fold), "medium_test")
    mapping = materialize(fit_label(train.select(*MEDIUM_TEXT).union(test.select(*MEDIUM_TEXT)), MEDIUM_TEXT), "codes")
    capped = year_weight(clip_outliers(train), weights)
    return (materialize(apply_label(capped, mapping, MEDIUM_TEXT), "medium_train"),
            materialize(apply_label(test, mapping, MEDIUM_TEXT), "medium_test"))


def forest_fit_predict(train: DataFrame, test: DataFrame, fold: int, trees: int = 500, depth: int = 10,
                       seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Random forest of the medium segment; predictions are not below 0."""
    forest = RandomForestRegressor(labelCol="sales", featureSubsetStrategy="all", numTrees=trees,
                                   maxDepth=depth, seed=seed)
    model = Pipeline(stages=[assembler(MEDIUM_FEATURES), forest]).fit(train)
    return model, predictions(model.transform(test), fold, clip_lower("prediction"))


def boosted_fit_predict(train: DataFrame, test: DataFrame, fold: int, iterations: int = 1000, depth: int = 8,
                        step: float = 0.02, seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Absolute-error boosting with row weights and 0.8 row and column samples.

    Rounds are chosen on the last 30 training days, never on the test rows.
    """
    boost = GBTRegressor(labelCol="sales", lossType="absolute", weightCol="weight", maxIter=iterations,
                         maxDepth=depth, stepSize=step, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
    model = fit_with_validation(boost, train.withColumn("fold", F.lit(fold)), MEDIUM_FEATURES, "id_date")
    return model, predictions(model.transform(test), fold, clip_lower("prediction"))


# --- forest in two tiers -----------------------------------------------------------------


def encode_fold(df: DataFrame, fold: Fold, features: list[str]) -> tuple[DataFrame, DataFrame]:
    """(train, test) with nulls as 0 and codes fitted on train; unseen values are -1."""
    filled = fill_constants(with_ids(df), 0, "0", subset=features)
    rows = materialize(assign_folds(filled, [fold]), "forest_rows")
    mapping = materialize(fit_ordinal(rows.where("split = 'train'"), ENCODED), "codes")
    coded = materialize(apply_label(rows, mapping, ENCODED, unknown=-1), "forest_codes")
    return coded.where("split = 'train'"), coded.where("split = 'test'")


def core_forest(df: DataFrame, core: list[str], fold: Fold, scope: str = "all", trees: int = 100,
                depth: int = 10, seed: int = 42) -> DataFrame:
    """Log-target forest of the core families, rows weighted by family sales.

    ``scope`` names the families whose mean is the unit of the weights: all or core.
    """
    rows = in_families(df, core)
    train, test = encode_fold(rows, fold, CORE_FEATURES)
    universe = train_rows(df if scope == "all" else rows, fold)
    weights = materialize(family_weights(universe), "weights").withColumnRenamed("family", "id_family")
    train = map_weight(train, weights, "id_family").withColumn("log_sales", F.log1p("sales"))
    forest = RandomForestRegressor(labelCol="log_sales", weightCol="weight", featureSubsetStrategy="all",
                                   numTrees=trees, maxDepth=depth, minInstancesPerNode=10, seed=seed)
    model = Pipeline(stages=[assembler(CORE_FEATURES), forest]).fit(train)
    return predictions(model.transform(test), fold[0], unlog("prediction"))


def hurdle(probability: Column, log_amount: Column) -> Column:
    """Chance of a sale times the amount given a sale."""
    return probability * unlog(log_amount)


def hurdle_forest(df: DataFrame, core: list[str], fold: Fold, trees: int = 100, depth: int = 30,
                  seed: int = 42) -> DataFrame:
    """Two-part forest of all families outside the core."""
    train, test = encode_fold(in_families(df, core, negate=True), fold, HURDLE_FEATURES)
    train = train.withColumns({
        "did_it_sell": F.when(F.col("sales") > 0, 1.0).otherwise(0.0), "log_sales": F.log1p("sales"),
    })
    vectors = assembler(HURDLE_FEATURES)
    sold = train.agg(F.avg("did_it_sell")).first()[0] or 0.0
    if sold == 0.0:  # nothing ever sold: nothing will
        return predictions(test, fold[0], F.lit(0.0))
    amount = RandomForestRegressor(labelCol="log_sales", featureSubsetStrategy="all", numTrees=trees,
                                   maxDepth=depth, seed=seed, predictionCol="log_amount")
    scored = vectors.transform(test)
    p = F.lit(1.0)
    if sold < 1.0:
        chance = RandomForestClassifier(labelCol="did_it_sell", numTrees=trees, maxDepth=depth, seed=seed,
                                        predictionCol="sold")
        scored = chance.fit(vectors.transform(train)).transform(scored)
        p = vector_to_array("probability")[1]
    scored = amount.fit(vectors.transform(train.where("did_it_sell = 1"))).transform(scored)
    return predictions(scored, fold[0], hurdle(p, F.col("log_amount")))


def two_tier_forest(df: DataFrame, core: list[str], folds: list[Fold], trees: int = 100, core_depth: int = 10,
                    rest_depth: int = 30) -> DataFrame:
    """Core families to the weighted forest, the rest to the hurdle, all folds in one frame."""
    parts = []
    for fold in folds:
        parts.append(core_forest(df, core, fold, trees=trees, depth=core_depth))
        parts.append(hurdle_forest(df, core, fold, trees=trees, depth=rest_depth))
    return union(parts)


# --- boosting over all families ----------------------------------------------------------


def nominal(df: DataFrame, mapping: DataFrame, columns: list[str]) -> DataFrame:
    """Tell tree learners that code columns are categories, not numbers."""
    sizes = {r["feature"]: r["n"] for r in mapping.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    marked = {
        c: F.col(c).cast("double").alias(c, metadata={"ml_attr": {"type": "nominal", "num_vals": sizes[c]}})
        for c in columns
    }
    return df.select(*[marked.get(c, F.col(f"`{c}`")) for c in df.columns])


def boosted_oof(df: DataFrame, folds: list[Fold], loss: str = "squared", iterations: int = 2000,
                depth: int = 6, step: float = 0.03, seed: int = 42, y: str = "sales",
                text_fill: str = "0") -> DataFrame:
    """Out-of-fold predictions of gradient boosting on every column but date and target.

    Text columns are categories over all rows. The last 30 training days choose the number
    of rounds where they hold enough rows. ``text_fill`` stands for a missing text.
    """
    features = features_of(df, [y, "date"])
    _, text = split_features(df.select(*features), [])
    prepared = materialize(with_ids(fill_constants(df, 0, text_fill, subset=features)), "boosted_input")
    mapping = materialize(fit_label(prepared, text), "codes")
    coded = materialize(apply_label(prepared, mapping, text), "boosted_codes")
    widest = mapping.groupBy("feature").count().agg(F.max("count")).first()[0] or 2
    # One table of vectors serves all folds; a fold is a range of its dates.
    vectors = materialize(assembler(features).transform(nominal(coded, mapping, text)).select(
        *IDS, "date", F.col(y).cast("double").alias(y), "features"), "boosted_vectors")
    daily = {r["date"]: r["count"] for r in vectors.groupBy("date").count().collect()}  # a row per day
    parts = []
    for fold in folds:
        boost = GBTRegressor(labelCol=y, lossType=loss, maxIter=iterations, maxDepth=depth, stepSize=step,
                             maxBins=max(32, widest), seed=seed)
        train, cut = train_rows(vectors, fold), cut_date(daily, fold)
        late = None if cut is None else train.where(F.col("date") > F.lit(cut))
        model = fit_rounds(boost, train if cut is None else train.where(F.col("date") <= F.lit(cut)), late)
        parts.append(predictions(model.transform(test_rows(vectors, fold)), fold[0], F.col("prediction"), y))
    return union(parts)
