"""Sources and sinks: each query writes what it reads to the shared folder first."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions import columns as C
from panelcast.functions import metrics as M
from panelcast.operators import encode, features, folds, trees
from panelcast.plans.catalog_base import KEY, round_all
from panelcast.plans.catalog_reports import ERR
from panelcast.plans.oracle import more, sql, sql_rounded
from panelcast.plans.panel import FOLDS, sales_panel, segments, stand_in_predictions
from panelcast.plans.registry import query
from panelcast.session import materialize, new_path
from panelcast.sources import readers, schema, writers

PANEL_SQL = "SELECT * EXCLUDE (transactions) FROM panel"


@query("s1_read_panel_csv", sql(PANEL_SQL))
def _(spark, sf):
    path = new_path(spark, "panel_csv")
    sales_panel(spark, sf).write.option("header", True).csv(path)
    return readers.read_panel(spark, path)


@query("s1_read_panel_parquet", sql(PANEL_SQL))
def _(spark, sf):
    path = new_path(spark, "panel_parquet")
    sales_panel(spark, sf).write.parquet(path)
    return readers.read_panel(spark, path, fmt="parquet")


@query("s2_read_segments_semicolon", sql("SELECT family, segment FROM seg"))
def _(spark, sf):
    path = new_path(spark, "segments_csv")
    untidy = segments(spark, sf).select(F.col("family").alias(" Family_Name"), F.col("segment").alias("Segment "))
    untidy.coalesce(1).write.options(header=True, sep=";").csv(path)
    return readers.read_segments(spark, path)


FOLD_COUNTS = """
SELECT f.fold, 'train' AS split, count(*) AS n, sum(p.sales) AS sales FROM folds f
JOIN panel p ON p.date BETWEEN f.train_start AND f.train_end GROUP BY f.fold
UNION ALL SELECT f.fold, 'test', count(*), sum(p.sales) FROM folds f
JOIN panel p ON p.date BETWEEN f.test_start AND f.test_end GROUP BY f.fold"""


def split_folds(spark, sf) -> DataFrame:
    return folds.assign_folds(sales_panel(spark, sf, oil=False).select(*KEY, "sales", "onpromotion"), FOLDS)


def fold_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("fold", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("sales").alias("sales"))


FOLD_SUMS = """
SELECT f.fold, 'train' AS split, count(*) AS n, sum(p.sales) AS sales, CASE WHEN f.fold < 5 THEN sum(p.onpromotion) END AS promo
FROM folds f JOIN panel p ON p.date BETWEEN f.train_start AND f.train_end GROUP BY f.fold
UNION ALL SELECT f.fold, 'test', count(*), sum(p.sales), CASE WHEN f.fold < 5 THEN sum(p.onpromotion) END
FROM folds f JOIN panel p ON p.date BETWEEN f.test_start AND f.test_end GROUP BY f.fold"""


@query("s3_read_folds", sql(FOLD_SUMS))
def _(spark, sf):
    folder = new_path(spark, "fold_files")
    rows = materialize(split_folds(spark, sf), "folds")
    # Files differ in the order of their columns, and the fifth pair lacks one.
    writers.write_fold_files(rows, folder, [1, 2])
    writers.write_fold_files(rows.select(*reversed(rows.columns)), folder, [3, 4])
    writers.write_fold_files(rows.drop("onpromotion"), folder, [5])
    # The sixth fold has a training file only, so it is left out.
    rows.where("fold = 3 and split = 'train'").drop("fold", "split").write.option("header", True).csv(
        f"{folder}/train_fold_6.csv")
    found = readers.read_folds(spark, folder, [1, 2, 3, 4, 5, 6, 7])
    return found.groupBy("fold", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sales").alias("sales"), F.sum("onpromotion").alias("promo"))


PERF_FILES = f"""
lagp AS (SELECT family, avg({ERR}) AS MAE, avg(y_true) AS mean_sale FROM oof GROUP BY family)"""


def _perf_files(spark, sf) -> tuple[str, str]:
    sums = materialize(M.error_sums(stand_in_predictions(spark, sf), ["family"]), "sums")
    lag, mean = new_path(spark, "lag_csv"), new_path(spark, "mean_csv")
    sums.select("family", M.mae().alias("MAE"), M.mean_sale().alias("mean_sales")).write.option("header", True).csv(lag)
    sums.select("family", M.mae().alias("MAE")).write.option("header", True).csv(mean)
    return lag, mean


@query("s4_read_tagged", sql_rounded("""
SELECT family, MAE, mean_sale, 'lag' AS model FROM lagp UNION ALL SELECT family, MAE, NULL, 'mean' FROM lagp""",
                                     ["MAE", "mean_sale"], ctes=PERF_FILES))
def _(spark, sf):
    lag, mean = _perf_files(spark, sf)
    return round_all(readers.read_tagged(spark, {lag: "lag", mean: "mean"}, rename={"mean_sales": "mean_sale"}))


@query("s5_find_inputs", sql("SELECT count(DISTINCT family) AS n_families FROM panel"))
def _(spark, sf):
    root = new_path(spark, "tree")
    sales_panel(spark, sf, oil=False).select("family", "sales").write.partitionBy("family").parquet(root)
    found = readers.find_inputs(spark, root, "part-*.parquet")
    folder = F.regexp_extract("path", r"family=([^/]+)/", 1)
    return found.agg(F.count_distinct(folder).alias("n_families"))


@query("s6_skip_missing", sql_rounded("SELECT family, MAE, mean_sale, 'lag' AS model FROM lagp",
                                      ["MAE", "mean_sale"], ctes=PERF_FILES))
def _(spark, sf):
    lag, _ = _perf_files(spark, sf)
    absent = new_path(spark, "absent_csv")
    return round_all(readers.read_tagged(spark, {lag: "lag", absent: "absent"}, rename={"mean_sales": "mean_sale"}))


@query("s7_require_columns", sql("SELECT date, store_nbr, family, sales FROM panel"))
def _(spark, sf):
    return schema.require_columns(sales_panel(spark, sf, oil=False), readers.REQUIRED).select(*readers.REQUIRED)


@query("s8_align_schema", sql("""
SELECT date, store_nbr, family, sales, NULL AS sales_lag_28, onpromotion FROM panel"""))
def _(spark, sf):
    master = spark.createDataFrame(
        [], "date date, store_nbr int, family string, sales double, sales_lag_28 double, onpromotion int").schema
    return schema.align_schema(sales_panel(spark, sf, oil=False), master)


@query("s9_normalize_headers", sql("SELECT family, segment FROM seg"))
def _(spark, sf):
    untidy = segments(spark, sf).toDF(" Family_Name ", "SEGMENT_label")
    return schema.normalize_headers(untidy, ["family", "segment"])


NUMERIC = ["onpromotion", "cluster", "dcoilwtico", "is_holiday", "day_of_week", "week_of_year", "month", "year", "is_weekend"]
TEXT = ["city", "state", "type"]


@query("s10_split_features", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{kind}' AS kind, count({c}) AS n FROM panel"
    for kind, names in (("numeric", NUMERIC), ("text", TEXT)) for c in names)))
def _(spark, sf):
    panel = sales_panel(spark, sf)
    numeric, text = features.split_features(panel, [*KEY, "sales"])
    kinds = {**{c: "numeric" for c in numeric}, **{c: "text" for c in text}}
    counts = panel.agg(*[F.count(c).alias(c) for c in kinds])
    rows = [F.struct(F.lit(c).alias("feature"), F.lit(k).alias("kind"), F.col(c).alias("n")) for c, k in kinds.items()]
    return counts.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


@query("s11_write_report", sql("SELECT family, printf('%.4f', avg(sales)) AS mean_sale FROM panel GROUP BY family"))
def _(spark, sf):
    means = sales_panel(spark, sf, oil=False).groupBy("family").agg(F.avg("sales").alias("mean_sale"))
    path = writers.write_report(means, new_path(spark, "report_csv"), 4)
    return spark.read.option("header", True).schema("family string, mean_sale string").csv(path)


@query("s11_write_report_null_metric", sql("""
SELECT family || ',' || coalesce(printf('%.4f', avg(CASE WHEN onpromotion > 2 THEN sales END)), '') AS line FROM panel GROUP BY family
UNION ALL SELECT 'family,promo_sale'"""))
def _(spark, sf):
    promoted = F.avg(F.when(F.col("onpromotion") > 2, F.col("sales")))
    means = sales_panel(spark, sf, oil=False).groupBy("family").agg(promoted.alias("promo_sale"))
    return spark.read.text(writers.write_report(means, new_path(spark, "report_csv"), 4)).withColumnRenamed("value", "line")


@query("s12_write_folds", sql(FOLD_COUNTS))
def _(spark, sf):
    path = writers.write_folds(split_folds(spark, sf), new_path(spark, "fold_table"))
    return fold_counts(readers.read_fold_table(spark, path))


@query("s13_save_load_state", sql("""
SELECT 'family' AS feature, v AS value, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INT) AS code FROM (SELECT DISTINCT family AS v FROM panel)"""))
def _(spark, sf):
    mapping = encode.fit_label(sales_panel(spark, sf, oil=False), ["family"])
    return writers.load_state(spark, writers.save_state(mapping, new_path(spark, "encoder")))


@query("s13_save_load_model", sql_rounded("""
SELECT date, store_nbr, family, (SELECT regr_intercept(sales, onpromotion) FROM panel)
       + (SELECT regr_slope(sales, onpromotion) FROM panel) * onpromotion AS y_pred FROM panel""", ["y_pred"]))
def _(spark, sf):
    panel = materialize(sales_panel(spark, sf, oil=False).select(*KEY, "sales", "onpromotion"), "panel")
    line = LinearRegression(labelCol="sales", solver="normal")
    model = Pipeline(stages=[trees.assembler(["onpromotion"]), line]).fit(panel)
    loaded = writers.load_state(spark, writers.save_state(model, new_path(spark, "model")))
    return round_all(loaded.transform(panel).select(*KEY, F.col("prediction").alias("y_pred")))


UPSERTED = f"""
lagm AS (SELECT family, 'lag' AS model, avg({ERR}) AS MAE FROM oof GROUP BY family),
meanm AS (SELECT family, 'mean' AS model, avg(abs(y_true - y_pred_mean)) AS MAE FROM oof GROUP BY family)"""


@query("s14_upsert", sql_rounded(
    "SELECT * FROM meanm UNION ALL SELECT family, model, MAE * 2 FROM lagm", ["MAE"], ctes=UPSERTED))
def _(spark, sf):
    oof = materialize(stand_in_predictions(spark, sf), "oof")
    lag = M.error_sums(oof, ["family"]).select("family", F.lit("lag").alias("model"), M.mae().alias("MAE"))
    mean = M.error_sums(oof, ["family"], yhat="y_pred_mean").select(
        "family", F.lit("mean").alias("model"), M.mae().alias("MAE"))
    base = new_path(spark, "comparison")
    writers.upsert_table(spark, base, lag, "model")
    writers.upsert_table(spark, base, mean, "model")
    return round_all(writers.upsert_table(spark, base, lag.withColumn("MAE", F.col("MAE") * 2), "model"))


@query("u4_replace_rows_of_key", sql_rounded("""
SELECT family, cluster, total FROM (SELECT family, cluster, sum(sales) AS total FROM panel GROUP BY family, cluster) WHERE cluster <> 1
UNION ALL SELECT family, 1, 0.0 FROM panel WHERE cluster = 1 GROUP BY family""", ["total"]))
def _(spark, sf):
    old = sales_panel(spark, sf, oil=False).groupBy("family", "cluster").agg(F.sum("sales").alias("total"))
    new = old.where("cluster = 1").withColumn("total", F.lit(0.0))
    return round_all(writers.upsert_by(old, new, "cluster"))


@query("s15_safe_name", sql("""
SELECT DISTINCT replace(replace(family || '/ ' || segment, '/', '_'), ' ', '_') AS name FROM seg"""))
def _(spark, sf):
    label = F.concat(F.col("family"), F.lit("/ "), F.col("segment"))
    return segments(spark, sf).select(C.safe_name(label).alias("name"))


@query("s15_write_scenarios", more("""
sc AS (SELECT p.date, p.store_nbr, p.family, s.scenario, p.sales FROM panel p CROSS JOIN (VALUES ('with_promo'), ('no_promo')) s(scenario)
       WHERE p.date BETWEEN DATE '2001-01-01' AND DATE '2001-01-31')""", """
SELECT family, scenario, count(*) AS n, sum(sales) AS sales FROM sc GROUP BY family, scenario"""))
def _(spark, sf):
    month = features.between_dates(sales_panel(spark, sf, oil=False), "2001-01-01", "2001-01-31")
    scenarios = features.promo_scenarios(features.add_promo_interactions(month)).select(*KEY, "sales", "scenario")
    path = writers.write_scenarios(scenarios, new_path(spark, "scenarios"))
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("family", "scenario").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("sales").cast("double")).alias("sales"))
