"""Leaf-wise boosting over all folds and what its features contribute to each prediction.

The queries grow fewer trees than the operator's default; see README for seconds a tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators import attribution, category_means, leafwise, reports, tree_shapley
from panelcast.operators.folds import assign_folds, assign_test_fold
from panelcast.operators.trees import IDS, union
from panelcast.plans.catalog_base import round_all
from panelcast.plans.catalog_identities import FOLD_ROWS, _near_zero
from panelcast.plans.catalog_trees import model_table
from panelcast.plans.oracle import more, sql
from panelcast.plans.panel import FOLDS, sales_panel
from panelcast.plans.registry import query
from panelcast.session import materialize

SETTINGS = {"rounds": 8, "rate": 0.3}
EXPLAINED = {"rounds": 4, "rate": 0.3}
# Every family has a segment, so the join of the shared rows keeps all of them.
ALL_ROWS = FOLD_ROWS.format(where="")


@query("m10_leafwise_oof")
def _(spark, sf):
    oof = leafwise.leafwise_oof(model_table(spark, sf), FOLDS, **SETTINGS)
    return round_all(reports.boosted_family_report(materialize(oof, "leafwise_oof")))


@query("m10_leafwise_rows", sql(ALL_ROWS))
def _(spark, sf):
    oof = leafwise.leafwise_oof(model_table(spark, sf), FOLDS, rounds=2, leaves=8)
    return oof.where("y_pred is not null").groupBy("fold", "family").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y_true").alias("sales"))


def explained(spark, sf) -> tuple[DataFrame, list[str]]:
    """(keys, fold, y_pred, base, values, contributions) of the test rows of all folds, written."""
    coded, features, sizes = leafwise.prepare(model_table(spark, sf))
    models = leafwise.fit(coded, features, sizes, FOLDS, **EXPLAINED)
    tests = materialize(assign_test_fold(coded, FOLDS).where("fold is not null"), "test_rows")
    keys = [*IDS, "fold"]
    scored = materialize(leafwise.predict(tests, models, features, [*IDS, "sales"]), "leafwise_scored")
    vector = F.array(*[F.col(c).cast("double") for c in features])
    parts = [
        tree_shapley.explain(tests.where(F.col("fold") == fold), spark.createDataFrame(rows, tree_shapley.NODE_FIELDS), vector, keys)
        for fold, rows in models.items()]
    return materialize(union(parts).join(scored, keys), "explained"), features


@query("m17_tree_contributions_add_up", sql(f"SELECT *, 0.0 AS gap FROM ({ALL_ROWS})"))
def _(spark, sf):
    rows, _ = explained(spark, sf)
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, b: a + b)
    gap = F.max(F.abs(_near_zero(total - F.col("y_pred"), F.col("y_pred"))))
    return rows.groupBy("fold", F.col("id_family").alias("family")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("sales").alias("sales"), gap.alias("gap"))


@query("m17_tree_summary")
def _(spark, sf):
    rows, features = explained(spark, sf)
    cells = tree_shapley.long_form(rows, features, ["fold"])
    table = union([attribution.contribution_summary(cells.where(F.col("fold") == fold[0])).withColumn("fold", F.lit(fold[0]))
                   for fold in FOLDS])
    return round_all(table)


@query("m17_tree_dependence")
def _(spark, sf):
    rows, features = explained(spark, sf)
    return round_all(attribution.dependence(tree_shapley.long_form(rows, features, [*IDS, "fold"]), "sales_lag_7"))


MEANS = """
coded AS (
  SELECT folds.fold, CASE WHEN p.date <= folds.train_end THEN 'train' ELSE 'test' END AS split, p.date, p.store_nbr, p.family, p.city,
         p.sales, md5('42|' || CAST(p.date AS VARCHAR) || '|' || p.store_nbr || '|' || p.family) AS place
  FROM panel p JOIN folds ON p.date BETWEEN folds.train_start AND folds.train_end OR p.date BETWEEN folds.test_start AND folds.test_end),
priors AS (SELECT fold, avg(sales) AS prior FROM coded WHERE split = 'train' GROUP BY fold),
family_sums AS (SELECT fold, family, sum(sales) AS s, count(*) AS n FROM coded WHERE split = 'train' GROUP BY fold, family),
city_sums AS (SELECT fold, city, sum(sales) AS s, count(*) AS n FROM coded WHERE split = 'train' GROUP BY fold, city),
ordered AS (
  SELECT fold, split, date, store_nbr, family, prior, coalesce(sum(sales) OVER f, 0) AS fs, count(sales) OVER f AS fn,
         coalesce(sum(sales) OVER c, 0) AS cs, count(sales) OVER c AS cn
  FROM coded JOIN priors USING (fold) WHERE split = 'train'
  WINDOW f AS (PARTITION BY fold, family ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         c AS (PARTITION BY fold, city ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  UNION ALL
  SELECT fold, split, date, store_nbr, family, prior, coalesce(f.s, 0), coalesce(f.n, 0), coalesce(c.s, 0), coalesce(c.n, 0)
  FROM coded JOIN priors USING (fold) LEFT JOIN family_sums f USING (fold, family) LEFT JOIN city_sums c USING (fold, city)
  WHERE split = 'test')"""


@query("m10_ordered_category_means", more(MEANS, """
SELECT fold, split, date, store_nbr, family, round((fs + prior) / (fn + 1), 6) AS family_mean, round((cs + prior) / (cn + 1), 6) AS city_mean
FROM ordered"""))
def _(spark, sf):
    """Training rows by the rows before them, test rows by all training rows of their fold."""
    rows = materialize(assign_folds(sales_panel(spark, sf, transactions=True), FOLDS).select(
        "fold", "split", "date", "store_nbr", "family", "city", "sales"), "fold_rows")
    train, texts = rows.where("split = 'train'"), ["family", "city"]
    ordered = category_means.ordered_means(train, texts, "sales", ["date", "store_nbr", "family"], ["fold"])
    means = materialize(category_means.fit_means(train, texts, "sales", ["fold"]), "category_means")
    priors = category_means.group_priors(train, ["fold"], "sales")
    test = category_means.apply_means(rows.where("split = 'test'"), means, priors, texts, ["fold"])
    return round_all(ordered.unionByName(test).drop("city", "sales"))
