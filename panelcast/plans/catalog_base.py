"""Projections, filters, joins, aggregates, windows, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions import columns as C
from panelcast.operators import aggregates as A
from panelcast.operators import encode, features, folds, joins, quantiles, ranking, windows
from panelcast.operators import series as S
from panelcast.plans.oracle import more, sql, sql_rounded
from panelcast.plans.panel import (
    FOLDS,
    YEAR_WEIGHTS,
    feature_panel,
    on_grid,
    panel_table,
    sales_panel,
    segments,
    stand_in_predictions,
)
from panelcast.plans.registry import query
from panelcast.session import materialize

KEY = ["date", "store_nbr", "family"]
ROLLING = ["rolling_mean_7", "rolling_mean_30", "rolling_std_7", "rolling_std_30"]


def round_all(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column: the last bits depend on the order of summation."""
    return df.select(*[
        F.round(F.col(f"`{n}`"), digits).alias(n) if t == "double" else F.col(f"`{n}`")
        for n, t in df.dtypes
    ])


# --- projections, filters, scalar functions ---------------------------------------------


@query("p1_between_dates", sql("""
SELECT date, store_nbr, family, sales FROM panel
WHERE date BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    panel = sales_panel(spark, sf, oil=False)
    return features.between_dates(panel, "2000-01-01", "2000-03-31").select(*KEY, "sales")


@query("p1_train_cut", sql("""
SELECT date, store_nbr, family, sales FROM panel
WHERE date >= DATE '1997-01-01' AND date < DATE '2001-01-01'"""))
def _(spark, sf):
    panel = features.between_dates(sales_panel(spark, sf, oil=False), lo="1997-01-01")
    return features.before_date(panel, "2001-01-01").select(*KEY, "sales")


@query("p2_keep_segment", sql("""
SELECT date, store_nbr, family, sales FROM panel
WHERE family IN (SELECT family FROM seg WHERE segment = 'Medium')"""))
def _(spark, sf):
    panel = panel_table(spark, sf)
    return joins.in_segment(panel, segments(spark, sf, panel), ["Medium"]).select(*KEY, "sales")


@query("p2_drop_segment", sql("""
SELECT date, store_nbr, family, sales FROM panel
WHERE family NOT IN (SELECT family FROM seg WHERE segment IN ('High', 'Medium'))"""))
def _(spark, sf):
    panel = panel_table(spark, sf)
    return joins.in_segment(panel, segments(spark, sf, panel), ["High", "Medium"], negate=True).select(*KEY, "sales")


@query("p3_select_existing", sql("SELECT onpromotion, is_weekend, is_holiday, month, dcoilwtico FROM panel"))
def _(spark, sf):
    candidates = ["onpromotion", "promo_weekend", "is_weekend", "is_holiday", "month", "dcoilwtico", "sales_lag_28"]
    return features.select_existing(sales_panel(spark, sf), candidates)


@query("p4_features_of", sql("SELECT * EXCLUDE (sales, date, transactions) FROM panel"))
def _(spark, sf):
    panel = sales_panel(spark, sf).withColumns({"sales_pred": F.lit(0.0), "fold": F.lit("fold_1")})
    return panel.select(*features.features_of(panel, ["sales", "date"]))


@query("p5_promo_interactions", sql("""
SELECT date, store_nbr, family, onpromotion * is_weekend AS promo_weekend,
       onpromotion * is_holiday AS promo_holiday FROM panel"""))
def _(spark, sf):
    return features.add_promo_interactions(sales_panel(spark, sf, oil=False)).select(
        *KEY, "promo_weekend", "promo_holiday"
    )


@query("p6_flags", sql("""
SELECT date, store_nbr, family, CASE WHEN sales > 0 THEN 1 ELSE 0 END AS did_it_sell,
       CASE WHEN onpromotion > 0 THEN 1 ELSE 0 END AS is_promo FROM panel"""))
def _(spark, sf):
    panel = features.add_flag(sales_panel(spark, sf, oil=False), F.col("sales") > 0, "did_it_sell")
    return features.add_flag(panel, F.col("onpromotion") > 0, "is_promo").select(*KEY, "did_it_sell", "is_promo")


@query("p7_clip_lower", sql("""
SELECT date, store_nbr, family,
       CASE WHEN sales_lag_7 IS NOT NULL THEN greatest(sales_lag_7 - 20, 0) END AS clipped FROM feat"""))
def _(spark, sf):
    panel = windows.series_select(sales_panel(spark, sf, oil=False), windows.add_lags([7]))
    return panel.select(*KEY, C.clip_lower(F.col("sales_lag_7") - 20).alias("clipped"))


@query("p8_log_target", sql_rounded(
    "SELECT date, store_nbr, family, ln(1 + sales) AS log_sales, greatest(exp(ln(1 + sales)) - 1, 0) AS back FROM panel",
    ["log_sales", "back"]))
def _(spark, sf):
    panel = sales_panel(spark, sf, oil=False).withColumn("log_sales", C.log_target("sales"))
    return round_all(panel.select(*KEY, "log_sales", C.unlog("log_sales").alias("back")))


@query("p9_fill_constants", sql("""
SELECT date, store_nbr, family, COALESCE(dcoilwtico, 0) AS dcoilwtico, COALESCE(sales_lag_7, 0) AS sales_lag_7,
       COALESCE(CASE WHEN store_nbr <> 1 THEN city END, 'missing') AS city FROM feat"""))
def _(spark, sf):
    panel = windows.series_select(sales_panel(spark, sf), windows.add_lags([7]))
    panel = panel.withColumn("city", F.when(F.col("store_nbr") != 1, F.col("city")))
    return features.fill_constants(panel, 0, "missing").select(*KEY, "dcoilwtico", "sales_lag_7", "city")


@query("p9_fill_text_with_number", sql("""
SELECT date, store_nbr, family, COALESCE(CASE WHEN store_nbr <> 1 THEN city END, '0') AS city FROM panel"""))
def _(spark, sf):
    panel = sales_panel(spark, sf, oil=False)
    panel = panel.withColumn("city", F.when(F.col("store_nbr") != 1, F.col("city")))
    return features.fill_constants(panel, 0).select(*KEY, "city")


@query("p10_drop_nulls", sql("""
SELECT date, store_nbr, family, dcoilwtico, sales_lag_30, round(rolling_mean_30, 6) AS rolling_mean_30 FROM feat
WHERE dcoilwtico IS NOT NULL AND sales_lag_30 IS NOT NULL AND rolling_mean_30 IS NOT NULL"""))
def _(spark, sf):
    # Nulls are dropped after the lags, on all columns: a day without an oil price goes too.
    panel = features.drop_nulls(feature_panel(spark, sf))
    return panel.select(*KEY, "dcoilwtico", "sales_lag_30", F.round("rolling_mean_30", 6).alias("rolling_mean_30"))


@query("p10_drop_nulls_subset", sql("""
SELECT date, store_nbr, family, dcoilwtico FROM panel WHERE dcoilwtico IS NOT NULL"""))
def _(spark, sf):
    return features.drop_nulls(sales_panel(spark, sf), ["dcoilwtico"]).select(*KEY, "dcoilwtico")


@query("p11_year_weight", sql("""
SELECT date, store_nbr, family, CASE WHEN year = 1999 THEN 1.5 ELSE 1.0 END AS weight FROM panel"""))
def _(spark, sf):
    return features.year_weight(sales_panel(spark, sf, oil=False), YEAR_WEIGHTS).select(*KEY, "weight")


@query("p12_promo_scenarios", sql("""
SELECT date, store_nbr, family, s.scenario,
       CASE WHEN s.scenario = 'with_promo' THEN 1.0 ELSE 0.0 END AS onpromotion,
       CASE WHEN s.scenario = 'with_promo' THEN is_weekend ELSE 0.0 END AS promo_weekend,
       CASE WHEN s.scenario = 'with_promo' THEN is_holiday ELSE 0.0 END AS promo_holiday
FROM panel CROSS JOIN (VALUES ('with_promo'), ('no_promo')) s(scenario)"""))
def _(spark, sf):
    panel = features.add_promo_interactions(sales_panel(spark, sf, oil=False))
    return features.promo_scenarios(panel).select(*KEY, "scenario", "onpromotion", "promo_weekend", "promo_holiday")


@query("p13_tag_and_rename", sql("""
SELECT 'SeasonalNaive' AS model, family AS family_name, round(avg(sales), 6) AS mean_sale FROM panel GROUP BY family"""))
def _(spark, sf):
    means = sales_panel(spark, sf, oil=False).groupBy("family").agg(F.avg("sales").alias("mean_sales"))
    return round_all(means.select(
        F.lit("SeasonalNaive").alias("model"), F.col("family").alias("family_name"), "mean_sales"
    ).withColumnRenamed("mean_sales", "mean_sale"))


@query("p15_ensure_month", sql("SELECT date, family, CAST(month(date) AS INT) AS month FROM panel"))
def _(spark, sf):
    return features.ensure_month(sales_panel(spark, sf, oil=False).select("date", "family"))


@query("p16_calendar_features", sql("""
SELECT DISTINCT date, day_of_week, week_of_year, month, year, is_weekend FROM panel"""))
def _(spark, sf):
    days = sales_panel(spark, sf, oil=False).select("date").distinct()
    return features.calendar_features(days)


@query("p17_cast_to_text", sql("""
SELECT DISTINCT CAST(store_nbr AS VARCHAR) AS store_nbr, CAST(cluster AS VARCHAR) AS cluster FROM panel"""))
def _(spark, sf):
    return encode.as_text(sales_panel(spark, sf, oil=False), ["store_nbr", "cluster"]).select(
        "store_nbr", "cluster"
    ).distinct()


@query("p18_rescale", sql("""
SELECT date, store_nbr, family, round(sales / scale * scale, 6) AS sales, round(sales / scale, 6) AS scaled
FROM panel, (SELECT greatest(quantile_cont(sales, 0.95), 1.0) AS scale FROM panel)"""))
def _(spark, sf):
    panel = panel_table(spark, sf)
    scale = quantiles.target_scale(panel).scalar()
    scaled = panel.select(*KEY, F.try_divide(F.col("sales"), scale).alias("scaled"))
    return round_all(scaled.withColumn("sales", C.rescale("scaled", scale)))


# --- joins -------------------------------------------------------------------------------


@query("j1_with_segment", sql("""
SELECT p.date, p.store_nbr, p.family, CASE WHEN seg.segment <> 'Low' THEN seg.segment END AS segment
FROM panel p LEFT JOIN seg ON p.family = seg.family"""))
def _(spark, sf):
    panel = panel_table(spark, sf)
    known = segments(spark, sf, panel).where("segment <> 'Low'")
    return joins.with_segment(panel, known).select(*KEY, "segment")


@query("j2_inner_segment", sql("""
SELECT p.date, p.store_nbr, p.family, seg.segment
FROM panel p JOIN seg ON p.family = seg.family WHERE seg.segment <> 'Low'"""))
def _(spark, sf):
    panel = panel_table(spark, sf)
    known = segments(spark, sf, panel).where("segment <> 'Low'")
    return joins.with_segment(panel, known, how="inner").select(*KEY, "segment")


@query("j3_fill_calendar", more("""
cal AS (SELECT family, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM rollup_daily GROUP BY family)""", """
SELECT cal.family, cal.date, COALESCE(r.sales, 0) AS sales, COALESCE(r.onpromotion, 0) AS onpromotion,
       COALESCE(r.is_holiday, 0) AS is_holiday, round(r.dcoilwtico, 6) AS dcoilwtico
FROM cal LEFT JOIN rollup_daily r ON cal.family = r.family AND cal.date = r.date"""))
def _(spark, sf):
    daily = A.daily_rollup(sales_panel(spark, sf))
    return round_all(windows.fill_calendar(daily, ["family"], S.ZERO_FILLED))


@query("j4_map_weight", sql_rounded("""
SELECT p.date, p.store_nbr, p.family, COALESCE(w.weight, 1.0) AS weight
FROM panel p LEFT JOIN (
  SELECT family, sum(sales) / (SELECT avg(t) FROM (SELECT sum(sales) t FROM panel
    WHERE family IN (SELECT family FROM seg WHERE segment = 'High') GROUP BY family)) AS weight
  FROM panel WHERE family IN (SELECT family FROM seg WHERE segment = 'High') GROUP BY family) w
ON p.family = w.family""", ["weight"]))
def _(spark, sf):
    panel = panel_table(spark, sf)
    core = joins.in_segment(panel, segments(spark, sf, panel), ["High"])
    weights = materialize(A.family_weights(core), "weights")
    return round_all(joins.map_weight(panel, weights).select(*KEY, "weight"))


@query("j5_segment_if_absent", sql("""
SELECT DISTINCT p.family, seg.segment FROM panel p LEFT JOIN seg ON p.family = seg.family"""))
def _(spark, sf):
    panel = panel_table(spark, sf)
    seg = segments(spark, sf, panel)
    once = joins.with_segment(panel, seg, only_if_absent=True)
    return joins.with_segment(once, seg.limit(0), only_if_absent=True).select("family", "segment").distinct()


@query("j6_decode", more("codes AS (SELECT family, dense_rank() OVER (ORDER BY family) - 1 AS code FROM (SELECT DISTINCT family FROM panel))", """
SELECT p.date, p.store_nbr, CAST(codes.code AS INT) AS family, p.family AS family_name
FROM panel p JOIN codes ON p.family = codes.family"""))
def _(spark, sf):
    panel = materialize(sales_panel(spark, sf, oil=False).select(*KEY), "panel")
    mapping = materialize(encode.fit_label(panel, ["family"]), "codes")
    coded = encode.apply_label(panel, mapping, ["family"])
    return encode.decode(coded, mapping, "family", "family_name")


@query("j7_attach_by_key", sql("""
SELECT date, store_nbr, family, sales, sales_lag_7 AS y_pred FROM feat"""))
def _(spark, sf):
    panel = panel_table(spark, sf).select(*KEY, "sales")
    predictions = windows.series_select(panel, windows.add_lags([7])).select(
        *KEY, F.col("sales_lag_7").alias("y_pred")
    )
    return joins.attach(panel, predictions, KEY)


@query("j8_assign_folds", sql("""
SELECT p.date, p.store_nbr, p.family, f.fold,
       CASE WHEN p.date BETWEEN f.train_start AND f.train_end THEN 'train' ELSE 'test' END AS split
FROM panel p JOIN folds f ON p.date BETWEEN f.train_start AND f.train_end OR p.date BETWEEN f.test_start AND f.test_end"""))
def _(spark, sf):
    return folds.assign_folds(sales_panel(spark, sf, oil=False), FOLDS).select(*KEY, "fold", "split")


@query("j9_semi_and_anti", sql("""
SELECT 'semi' AS kind, count(*) AS n FROM panel WHERE family IN (SELECT family FROM seg WHERE segment = 'High')
UNION ALL
SELECT 'anti', count(*) FROM panel WHERE family NOT IN (SELECT family FROM seg WHERE segment = 'High')"""))
def _(spark, sf):
    panel = panel_table(spark, sf)
    seg = segments(spark, sf, panel)
    semi = joins.in_segment(panel, seg, ["High"]).select(F.lit("semi").alias("kind"))
    anti = joins.in_segment(panel, seg, ["High"], negate=True).select(F.lit("anti").alias("kind"))
    return semi.unionByName(anti).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


# --- aggregations ------------------------------------------------------------------------


@query("a1_daily_rollup", sql_rounded("SELECT * FROM rollup_daily", ["dcoilwtico"]))
def _(spark, sf):
    return round_all(A.daily_rollup(sales_panel(spark, sf)))


@query("a2_daily_actual_vs_pred", sql_rounded("""
SELECT o.family, o.date, sum(o.y_true) AS actual, sum(o.y_pred_mean) AS baseline,
       max(CASE WHEN p.onpromotion > 0 THEN 1 ELSE 0 END) AS promo_flag
FROM oof o JOIN panel p ON o.date = p.date AND o.store_nbr = p.store_nbr AND o.family = p.family
GROUP BY o.family, o.date""", ["actual", "baseline"]))
def _(spark, sf):
    scored = windows.series_select(sales_panel(spark, sf, oil=False),
                                   [*windows.add_lags([7]), *windows.add_rolling([30], "mean")])
    scored = folds.assign_test_fold(scored, FOLDS).na.drop(subset=["sales_lag_7", "rolling_mean_30"])
    scored = scored.withColumn("y_pred_mean", on_grid("rolling_mean_30"))
    return round_all(A.daily_actual_vs_pred(scored, ["family"], "sales", "y_pred_mean", "onpromotion"))


@query("a3_scenario_daily", sql("""
SELECT family, date, sum(sales + 5.0 * 0) AS no_promo, sum(sales + 5.0) AS with_promo
FROM panel WHERE date BETWEEN DATE '2001-01-01' AND DATE '2001-01-31' GROUP BY family, date"""))
def _(spark, sf):
    month = features.between_dates(sales_panel(spark, sf, oil=False), "2001-01-01", "2001-01-31")
    scenarios = features.promo_scenarios(features.add_promo_interactions(month))
    return A.scenario_daily(scenarios.withColumn("sales_pred", F.col("sales") + 5.0 * F.col("onpromotion")))


@query("a4_promo_vs_nonpromo", sql_rounded("""
SELECT p.family, seg.segment, avg(CASE WHEN onpromotion > 0 THEN NULL ELSE sales END) AS avg_sales_nonpromo,
       avg(CASE WHEN onpromotion > 0 THEN sales END) AS avg_sales_promo,
       (avg(CASE WHEN onpromotion > 0 THEN sales END) - avg(CASE WHEN onpromotion > 0 THEN NULL ELSE sales END))
         / nullif(avg(CASE WHEN onpromotion > 0 THEN NULL ELSE sales END), 0) AS uplift_rel
FROM panel p JOIN seg ON p.family = seg.family GROUP BY p.family, seg.segment""",
                                           ["avg_sales_nonpromo", "avg_sales_promo", "uplift_rel"]))
def _(spark, sf):
    panel = panel_table(spark, sf)
    return round_all(A.promo_vs_nonpromo(joins.with_segment(panel, segments(spark, sf, panel))))


@query("a5_family_totals", sql("""
SELECT p.family, sum(sales) AS total_sales, seg.segment FROM panel p JOIN seg ON p.family = seg.family
GROUP BY p.family, seg.segment ORDER BY total_sales DESC, p.family LIMIT 10"""))
def _(spark, sf):
    panel = panel_table(spark, sf)
    totals = joins.with_segment(A.family_totals(panel), segments(spark, sf, panel))
    return ranking.top_k(totals, "total_sales", 10, ["family"])


def _heatmap_sql(row: str) -> str:
    months = ", ".join(f"sum(CASE WHEN month = {m} THEN sales ELSE 0 END) AS m{m}" for m in range(1, 13))
    return sql(f"SELECT {row}, {months} FROM panel GROUP BY {row}")


@query("a6_cluster_heatmap", _heatmap_sql("cluster"))
def _(spark, sf):
    return A.sales_heatmap(sales_panel(spark, sf, oil=False), "cluster")


@query("a6_city_heatmap", _heatmap_sql("city"))
def _(spark, sf):
    return A.sales_heatmap(sales_panel(spark, sf, oil=False), "city")


DAILY_CLUSTER = """
dc AS (SELECT date, cluster, sum(sales) AS sales, avg(dcoilwtico) AS dcoilwtico FROM panel
       GROUP BY date, cluster HAVING avg(dcoilwtico) IS NOT NULL)"""
CORR = DAILY_CLUSTER + """,
corr AS (SELECT cluster, covar_pop(sales, dcoilwtico) / nullif(stddev_pop(sales) * stddev_pop(dcoilwtico), 0)
         AS corr_sales_oil FROM dc GROUP BY cluster)"""
PICKED = CORR + """,
picked AS (
  (SELECT cluster, corr_sales_oil, 'sensitive' AS kind FROM corr ORDER BY abs(corr_sales_oil) DESC, cluster LIMIT 3)
  UNION ALL
  (SELECT cluster, corr_sales_oil, 'non_sensitive' FROM corr ORDER BY abs(corr_sales_oil), cluster LIMIT 3))"""


@query("a7_daily_cluster", sql_rounded("SELECT * FROM dc", ["dcoilwtico"], ctes=DAILY_CLUSTER))
def _(spark, sf):
    return round_all(A.daily_cluster(sales_panel(spark, sf)))


@query("a8_oil_correlation", sql_rounded("SELECT * FROM corr", ["corr_sales_oil"], ctes=CORR))
def _(spark, sf):
    return round_all(A.oil_correlation(A.daily_cluster(sales_panel(spark, sf))))


@query("a9_clip_outliers", sql_rounded("""
SELECT f.fold, p.date, p.store_nbr, p.family, least(p.sales, t.cap) AS sales, t.cap
FROM panel p JOIN folds f ON p.date BETWEEN f.train_start AND f.train_end
JOIN (SELECT fold, family, greatest(quantile_cont(sales, 0.99), 10) AS cap FROM panel
  JOIN folds ON date BETWEEN train_start AND train_end GROUP BY fold, family) t ON p.family = t.family AND f.fold = t.fold
WHERE p.family IN (SELECT family FROM seg WHERE segment = 'Medium')""", ["sales", "cap"]))
def _(spark, sf):
    panel = panel_table(spark, sf)
    medium = joins.in_segment(panel, segments(spark, sf, panel), ["Medium"])
    train = materialize(folds.assign_folds(medium, FOLDS).where("split = 'train'"), "train")
    return round_all(quantiles.clip_outliers(train, by=["fold", "family"], keep_cap=True).select("fold", *KEY, "sales", "cap"))


@query("a10_target_scale", sql("SELECT round(greatest(quantile_cont(sales, 0.95), 1.0), 6) AS scale FROM panel"))
def _(spark, sf):
    return round_all(quantiles.target_scale(panel_table(spark, sf)))


@query("a16_family_weights", sql_rounded("""
SELECT family, sum(sales) / (SELECT avg(t) FROM (SELECT sum(sales) t FROM panel GROUP BY family)) AS weight
FROM panel GROUP BY family""", ["weight"]))
def _(spark, sf):
    return round_all(A.family_weights(sales_panel(spark, sf, oil=False)))


@query("a16_family_weights_core", sql_rounded("""
SELECT family, sum(sales) / (SELECT avg(t) FROM (SELECT sum(sales) t FROM panel
  WHERE family IN (SELECT family FROM seg WHERE segment = 'High') GROUP BY family)) AS weight
FROM panel WHERE family IN (SELECT family FROM seg WHERE segment = 'High') GROUP BY family""", ["weight"]))
def _(spark, sf):
    panel = panel_table(spark, sf)
    return round_all(A.family_weights(joins.in_segment(panel, segments(spark, sf, panel), ["High"])))


@query("a17_having_count", sql("""
SELECT date, store_nbr, family, sales FROM panel
WHERE (store_nbr, family) IN (SELECT (store_nbr, family) FROM panel GROUP BY store_nbr, family HAVING count(*) >= 500)"""))
def _(spark, sf):
    panel = sales_panel(spark, sf, oil=False)
    return A.having_count(panel, ["store_nbr", "family"], 500).select(*KEY, "sales")


def _stats_sql(columns: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, avg({c}) AS mean, "
        f"stddev_pop({c}) AS std FROM feat" for c in columns)
    return sql_rounded(parts, ["min", "max", "mean", "std"])


STAT_COLUMNS = ["onpromotion", "dcoilwtico", "sales_lag_7", "rolling_mean_30"]


@query("a18_fit_stats", _stats_sql(STAT_COLUMNS))
def _(spark, sf):
    return round_all(A.fit_stats(feature_panel(spark, sf), STAT_COLUMNS))


@query("a18_median", sql_rounded("""
SELECT family, median(sales) AS sales, median(dcoilwtico) AS dcoilwtico, median(sales_lag_7) AS sales_lag_7,
       median(rolling_mean_30) AS rolling_mean_30 FROM feat GROUP BY family""",
                                 ["sales", "dcoilwtico", "sales_lag_7", "rolling_mean_30"]))
def _(spark, sf):
    table = materialize(feature_panel(spark, sf), "features")
    return round_all(quantiles.exact_quantile(
        table, ["family"], ["sales", "dcoilwtico", "sales_lag_7", "rolling_mean_30"], 0.5))


@query("a18_most_frequent", sql("""
SELECT 'city' AS feature, (SELECT city FROM panel GROUP BY city ORDER BY count(*) DESC, city LIMIT 1) AS value
UNION ALL SELECT 'state', (SELECT state FROM panel GROUP BY state ORDER BY count(*) DESC, state LIMIT 1)
UNION ALL SELECT 'type', (SELECT type FROM panel GROUP BY type ORDER BY count(*) DESC, type LIMIT 1)"""))
def _(spark, sf):
    return A.most_frequent(sales_panel(spark, sf, oil=False), ["city", "state", "type"])


@query("a19_family_mean", sql_rounded("SELECT family, avg(sales) AS mean_sale FROM panel GROUP BY family", ["mean_sale"]))
def _(spark, sf):
    return round_all(sales_panel(spark, sf, oil=False).groupBy("family").agg(F.avg("sales").alias("mean_sale")))


@query("a23_distinct_values", sql("SELECT DISTINCT family FROM panel"))
def _(spark, sf):
    return A.distinct_values(sales_panel(spark, sf, oil=False), "family")


# --- windows -----------------------------------------------------------------------------


@query("w1_add_lags", sql("""
SELECT date, store_nbr, family, sales_lag_7, sales_lag_14, sales_lag_30,
       lag(sales, 28) OVER (PARTITION BY store_nbr, family ORDER BY date) AS sales_lag_28 FROM feat"""))
def _(spark, sf):
    return windows.series_select(sales_panel(spark, sf, oil=False), windows.add_lags([7, 14, 28, 30])).select(
        *KEY, "sales_lag_7", "sales_lag_14", "sales_lag_28", "sales_lag_30")


@query("w2_rolling_mean", sql_rounded(
    "SELECT date, store_nbr, family, rolling_mean_7, rolling_mean_30 FROM feat", ["rolling_mean_7", "rolling_mean_30"]))
def _(spark, sf):
    panel = sales_panel(spark, sf, oil=False)
    return round_all(windows.series_select(panel, windows.add_rolling([7, 30], "mean")).select(
        *KEY, "rolling_mean_7", "rolling_mean_30"))


@query("w3_rolling_std", sql_rounded(
    "SELECT date, store_nbr, family, rolling_std_7, rolling_std_30 FROM feat", ["rolling_std_7", "rolling_std_30"]))
def _(spark, sf):
    panel = sales_panel(spark, sf, oil=False)
    return round_all(windows.series_select(panel, windows.add_rolling([7, 30], "std")).select(
        *KEY, "rolling_std_7", "rolling_std_30"))


@query("w4_make_sequences", sql("""
SELECT date, store_nbr, family, sales AS target, oldest, newest, 30 AS steps, total FROM (
  SELECT *, lag(sales, 30) OVER w AS oldest, lag(sales, 1) OVER w AS newest, row_number() OVER w AS r,
         sum(sales) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS total
  FROM panel WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date)) WHERE r > 30"""))
def _(spark, sf):
    sequences = windows.make_sequences(sales_panel(spark, sf, oil=False), ["sales"], 30)
    return sequences.select(
        *KEY, "target", F.col("sequence")[0][0].alias("oldest"), F.col("sequence")[29][0].alias("newest"),
        F.size("sequence").alias("steps"),
        F.aggregate("sequence", F.lit(0.0), lambda acc, step: acc + step[0]).alias("total"))


FILLED = """
cal AS (SELECT family, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM rollup_daily GROUP BY family),
filled AS (SELECT cal.family, cal.date, COALESCE(r.sales, 0) AS sales, COALESCE(r.onpromotion, 0) AS onpromotion,
                  COALESCE(r.is_holiday, 0) AS is_holiday, r.dcoilwtico
           FROM cal LEFT JOIN rollup_daily r ON cal.family = r.family AND cal.date = r.date),
marked AS (SELECT *, last_value(CASE WHEN dcoilwtico IS NOT NULL THEN date END IGNORE NULLS) OVER a AS pd,
                  last_value(dcoilwtico IGNORE NULLS) OVER a AS pv,
                  first_value(CASE WHEN dcoilwtico IS NOT NULL THEN date END IGNORE NULLS) OVER b AS nd,
                  first_value(dcoilwtico IGNORE NULLS) OVER b AS nv
           FROM filled
           WINDOW a AS (PARTITION BY family ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  b AS (PARTITION BY family ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
daily AS (SELECT family, date, sales, onpromotion, is_holiday,
                 CASE WHEN dcoilwtico IS NOT NULL THEN dcoilwtico
                      WHEN pv IS NULL THEN COALESCE(nv, 0) WHEN nv IS NULL THEN pv
                      ELSE pv + (nv - pv) * (date - pd) / (nd - pd) END AS dcoilwtico
          FROM marked)"""


@query("w5_interpolate", sql_rounded("SELECT * FROM daily", ["dcoilwtico"], 9, ctes=FILLED))
def _(spark, sf):
    return round_all(S.daily_series(sales_panel(spark, sf)), 9)


@query("w6_holdout_last", more(FILLED, """
SELECT family, date, sales, row_number() OVER (PARTITION BY family ORDER BY date DESC) <= 90 AS is_test
FROM daily WHERE family IN (SELECT family FROM daily GROUP BY family HAVING count(*) > 90)"""))
def _(spark, sf):
    daily = windows.fill_calendar(A.daily_rollup(sales_panel(spark, sf)), ["family"], S.ZERO_FILLED)
    return windows.holdout_last(daily, 90, ["family"]).select("family", "date", "sales", "is_test")


@query("w7_validation_cut", sql("""
SELECT t.fold, t.date, t.store_nbr, t.family,
       (t.date > c.cut AND c.n_val >= 50 AND c.n_rest > 0) AS is_validation
FROM (SELECT f.fold, p.date, p.store_nbr, p.family FROM panel p JOIN folds f ON p.date BETWEEN f.train_start AND f.train_end) t
JOIN (SELECT fold, cut, count(*) FILTER (date > cut) AS n_val, count(*) FILTER (date <= cut) AS n_rest FROM (
        SELECT f.fold, p.date, max(p.date) OVER (PARTITION BY f.fold) - 30 AS cut
        FROM panel p JOIN folds f ON p.date BETWEEN f.train_start AND f.train_end) GROUP BY fold, cut) c ON t.fold = c.fold"""))
def _(spark, sf):
    train = folds.assign_folds(sales_panel(spark, sf, oil=False), FOLDS).where("split = 'train'")
    return folds.validation_cut(train, 30).select("fold", *KEY, "is_validation")


@query("w8_first_of_group", sql("""
SELECT o.family, min(o.segment) AS segment, count(*) AS n FROM oof o GROUP BY o.family"""))
def _(spark, sf):
    # The segment depends on the family alone, so any row of the group gives it.
    panel = panel_table(spark, sf)
    tagged = joins.with_segment(stand_in_predictions(spark, sf, panel), segments(spark, sf, panel))
    return tagged.groupBy("family").agg(F.min("segment").alias("segment"), F.count(F.lit(1)).alias("n"))


@query("w9_tail_rows", sql("""
SELECT family, date, sales FROM (
  SELECT family, date, sales, row_number() OVER (PARTITION BY family ORDER BY date DESC) AS r FROM rollup_daily)
WHERE r <= 180"""))
def _(spark, sf):
    return windows.tail_rows(A.daily_rollup(sales_panel(spark, sf)), 180, ["family"]).select("family", "date", "sales")


# --- sort, top-k, sampling ---------------------------------------------------------------


@query("t1_total_sort", sql("SELECT date, store_nbr, family, sales FROM panel ORDER BY date, store_nbr, family"))
def _(spark, sf):
    return sales_panel(spark, sf, oil=False).select(*KEY, "sales").orderBy(*KEY)


@query("t2_top_k", sql("""
SELECT date, store_nbr, family, sales FROM panel ORDER BY sales DESC, date, store_nbr, family LIMIT 10"""))
def _(spark, sf):
    return ranking.top_k(sales_panel(spark, sf, oil=False).select(*KEY, "sales"), "sales", 10, KEY)


@query("t3_sensitive_groups", sql_rounded("SELECT * FROM picked", ["corr_sales_oil"], ctes=PICKED))
def _(spark, sf):
    return round_all(A.sensitive_groups(A.oil_correlation(A.daily_cluster(sales_panel(spark, sf)))))


@query("t4_sensitivity_series", sql_rounded("""
SELECT kind, date, sum(sales) AS sales, avg(dcoilwtico) AS dcoilwtico
FROM dc JOIN picked ON dc.cluster = picked.cluster GROUP BY kind, date""", ["dcoilwtico"], ctes=PICKED))
def _(spark, sf):
    daily = materialize(A.daily_cluster(sales_panel(spark, sf)), "daily_cluster")
    picked = A.sensitive_groups(A.oil_correlation(daily))
    return round_all(A.sensitivity_series(daily, picked))


@query("t5_sample_n", sql("SELECT least(count(*), 5000) AS n, least(count(*), 5000) AS n_distinct FROM panel"))
def _(spark, sf):
    picked = ranking.sample_n(sales_panel(spark, sf, oil=False).select(*KEY), 5000, KEY)
    return picked.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*KEY).alias("n_distinct"))


# --- set operations ----------------------------------------------------------------------


@query("u1_union_predictions", sql("""
SELECT 'lag' AS model, date, store_nbr, family, fold, round(y_pred, 6) AS y_pred FROM oof
UNION ALL SELECT 'mean', date, store_nbr, family, fold, round(y_pred_mean, 6) FROM oof"""))
def _(spark, sf):
    oof = stand_in_predictions(spark, sf, panel_table(spark, sf))
    lag = oof.select(F.lit("lag").alias("model"), *KEY, "fold", "y_pred")
    mean = oof.select(F.lit("mean").alias("model"), *KEY, "fold", F.col("y_pred_mean").alias("y_pred"))
    return round_all(lag.unionByName(mean))


@query("u2_union_missing_columns", sql_rounded("""
SELECT family, sum(sales) AS total_sales, NULL AS cluster, NULL AS mean_sale FROM panel GROUP BY family
UNION ALL SELECT NULL, NULL, cluster, avg(sales) FROM panel GROUP BY cluster""", ["mean_sale"]))
def _(spark, sf):
    panel = panel_table(spark, sf)
    by_cluster = panel.groupBy("cluster").agg(F.avg("sales").alias("mean_sale"))
    return round_all(A.family_totals(panel).unionByName(by_cluster, allowMissingColumns=True))


@query("u3_distinct_union", sql("""
SELECT DISTINCT city AS value FROM panel JOIN folds
ON date BETWEEN train_start AND train_end OR date BETWEEN test_start AND test_end"""))
def _(spark, sf):
    rows = folds.assign_folds(panel_table(spark, sf), FOLDS)
    return encode.distinct_union(rows.where("split = 'train'"), rows.where("split = 'test'"), "city")


# --- encoders, imputation, scaling -------------------------------------------------------

TEXT_CODES = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, v AS value, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INT) AS code "
    f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM panel)"
    for c in ("store_nbr", "family", "city", "state", "type", "cluster", "week_of_year"))


@query("f1_fit_label_text", sql(TEXT_CODES))
def _(spark, sf):
    columns = ["store_nbr", "family", "city", "state", "type", "cluster", "week_of_year"]
    return encode.fit_label(sales_panel(spark, sf, oil=False), columns)


@query("f1_apply_label_native", sql("""
SELECT date, store_nbr, family, CAST((SELECT count(DISTINCT q.week_of_year) FROM panel q WHERE q.week_of_year < p.week_of_year) AS INT) AS week_of_year
FROM panel p"""))
def _(spark, sf):
    panel = materialize(sales_panel(spark, sf, oil=False).select(*KEY, "week_of_year"), "panel")
    codes = materialize(encode.fit_label_native(panel, "week_of_year"), "codes")
    return encode.apply_label_native(panel, codes, "week_of_year").select(*KEY, "week_of_year")


ORDINAL_CTES = """
train AS (SELECT * FROM panel WHERE date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' AND store_nbr <> 3),
codes AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT city AS v FROM train))"""


@query("f2_ordinal_unknown", more(ORDINAL_CTES, """
SELECT p.date, p.store_nbr, p.family, CAST(COALESCE(c.code, -1) AS INT) AS city FROM panel p LEFT JOIN codes c ON p.city = c.v
WHERE p.date BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'"""))
def _(spark, sf):
    panel = materialize(sales_panel(spark, sf, oil=False).select(*KEY, "city"), "panel")
    train = folds.train_rows(panel, FOLDS[0]).where("store_nbr <> 3")
    mapping = materialize(encode.fit_label(train, ["city"]), "codes")
    return encode.apply_label(folds.test_rows(panel, FOLDS[0]), mapping, ["city"], unknown=-1)


@query("f3_one_hot", sql("""
SELECT date, store_nbr, family,
       CASE WHEN c = 'type_0' THEN 1 ELSE 0 END AS type_0, CASE WHEN c = 'type_1' THEN 1 ELSE 0 END AS type_1,
       CASE WHEN c = 'type_2' THEN 1 ELSE 0 END AS type_2
FROM (SELECT *, COALESCE(CASE WHEN type <> 'type_4' THEN type END,
        (SELECT type FROM panel WHERE type <> 'type_4' GROUP BY type ORDER BY count(*) DESC, type LIMIT 1)) AS c FROM panel)"""))
def _(spark, sf):
    # type_4 is nulled (so imputed with the mode); type_3 is left out of the categories (so all zeros).
    panel = materialize(sales_panel(spark, sf, oil=False).withColumn(
        "type", F.when(F.col("type") != "type_4", F.col("type"))).select(*KEY, "type"), "panel")
    imputed = encode.impute_most_frequent(panel, ["type"])
    return encode.one_hot(imputed, {"type": ["type_0", "type_1", "type_2"]}).drop("type")


@query("f4_impute_median", sql_rounded("""
SELECT f.date, f.store_nbr, f.family, COALESCE(f.dcoilwtico, m.o) AS dcoilwtico, COALESCE(f.sales_lag_14, m.l) AS sales_lag_14
FROM feat f JOIN (SELECT family, median(dcoilwtico) AS o, median(sales_lag_14) AS l FROM feat GROUP BY family) m
ON f.family = m.family""", ["dcoilwtico", "sales_lag_14"]))
def _(spark, sf):
    table = materialize(feature_panel(spark, sf), "features")
    filled = quantiles.impute_median(table, ["dcoilwtico", "sales_lag_14"], by=["family"])
    return round_all(filled.select(*KEY, "dcoilwtico", "sales_lag_14"))


@query("f5_minmax", sql_rounded("""
SELECT date, store_nbr, family,
  COALESCE((onpromotion - min(onpromotion) OVER ()) / nullif(max(onpromotion) OVER () - min(onpromotion) OVER (), 0), 0) AS onpromotion,
  COALESCE((sales_lag_7 - min(sales_lag_7) OVER ()) / nullif(max(sales_lag_7) OVER () - min(sales_lag_7) OVER (), 0), 0) AS sales_lag_7,
  COALESCE((rolling_std_7 - min(rolling_std_7) OVER ()) / nullif(max(rolling_std_7) OVER () - min(rolling_std_7) OVER (), 0), 0) AS rolling_std_7
FROM feat WHERE dcoilwtico IS NOT NULL AND sales_lag_30 IS NOT NULL AND rolling_mean_30 IS NOT NULL""",
                                ["onpromotion", "sales_lag_7", "rolling_std_7"]))
def _(spark, sf):
    table = materialize(features.drop_nulls(feature_panel(spark, sf)), "features")
    scaled = encode.minmax(table, ["onpromotion", "sales_lag_7", "rolling_std_7"], fit_on=table)
    return round_all(scaled.select(*KEY, "onpromotion", "sales_lag_7", "rolling_std_7"))


@query("f6_standardize", sql_rounded("""
SELECT f.date, f.store_nbr, f.family, (f.sales_lag_7 - m) / CASE WHEN s = 0 THEN 1 ELSE s END AS sales_lag_7
FROM feat f JOIN (SELECT family, avg(sales_lag_7) AS m, stddev_pop(sales_lag_7) AS s FROM feat GROUP BY family) t
ON f.family = t.family""", ["sales_lag_7"]))
def _(spark, sf):
    table = materialize(windows.series_select(sales_panel(spark, sf, oil=False), windows.add_lags([7])), "features")
    return round_all(encode.standardize(table, ["sales_lag_7"], by=["family"]).select(*KEY, "sales_lag_7"))


@query("f7_index_categories", sql("""
SELECT date, store_nbr, family, CAST(dense_rank() OVER (ORDER BY family) - 1 AS INT) AS family_ix,
       CAST(dense_rank() OVER (ORDER BY city) - 1 AS INT) AS city_ix FROM panel"""))
def _(spark, sf):
    panel = materialize(sales_panel(spark, sf, oil=False).select(*KEY, "city"), "panel")
    return encode.index_categories(panel, ["family", "city"]).select(*KEY, "family_ix", "city_ix")
