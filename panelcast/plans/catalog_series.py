"""Daily series models: seasonal ARX, additive model, components, and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators import additive, arx, joins, reports, windows
from panelcast.operators import series as S
from panelcast.plans.catalog_base import FILLED, round_all
from panelcast.plans.oracle import more
from panelcast.plans.panel import panel_table, sales_panel, segments
from panelcast.plans.registry import query
from panelcast.session import materialize


def daily(spark, sf, panel: DataFrame | None = None) -> DataFrame:
    return materialize(S.daily_series(sales_panel(spark, sf) if panel is None else panel), "daily_series")


@query("m12_choose_differences", more(FILLED + """,
t AS (SELECT family, date, sales, row_number() OVER (PARTITION BY family ORDER BY date DESC) AS r FROM daily),
l AS (SELECT family, sales AS y, lag(sales, 1) OVER w AS y1, lag(sales, 7) OVER w AS y7, lag(sales, 8) OVER w AS y8
      FROM t WHERE r > 90 WINDOW w AS (PARTITION BY family ORDER BY date)),
v AS (SELECT family, var_pop(y) AS v00, var_pop(y - y1) AS v10, var_pop(y - y7) AS v01, var_pop(y - y1 - y7 + y8) AS v11
      FROM l GROUP BY family HAVING count(*) >= 80)""", """
SELECT family, CASE WHEN v00 = m THEN 0 WHEN v10 = m THEN 1 WHEN v01 = m THEN 0 ELSE 1 END AS d,
       CASE WHEN v00 = m OR v10 = m THEN 0 ELSE 1 END AS sd, 'fitted' AS status
FROM (SELECT *, least(v00, v10, v01, v11) AS m FROM v)"""))
def _(spark, sf):
    split = windows.holdout_last(daily(spark, sf), 90, ["family"])
    return arx.choose_differences(split.where("not is_test"))


# The order without lags regresses the differenced series on the differenced regressors; its
# rows are those whose long lags and shock lags all exist.
NO_LAGS = FILLED + """,
t AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY date DESC) AS back,
             row_number() OVER (PARTITION BY family ORDER BY date) AS pos FROM daily),
l AS (SELECT family, pos, back, sales AS y, lag(sales, 1) OVER w AS y1, lag(sales, 7) OVER w AS y7, lag(sales, 8) OVER w AS y8,
             onpromotion AS a0, lag(onpromotion, 1) OVER w AS a1, lag(onpromotion, 7) OVER w AS a7, lag(onpromotion, 8) OVER w AS a8,
             is_holiday AS h0, lag(is_holiday, 1) OVER w AS h1, lag(is_holiday, 7) OVER w AS h7, lag(is_holiday, 8) OVER w AS h8,
             dcoilwtico AS o0, lag(dcoilwtico, 1) OVER w AS o1, lag(dcoilwtico, 7) OVER w AS o7, lag(dcoilwtico, 8) OVER w AS o8
      FROM t WINDOW w AS (PARTITION BY family ORDER BY date)),
v AS (SELECT family, var_pop(y) AS v00, var_pop(y - y1) AS v10, var_pop(y - y7) AS v01, var_pop(y - y1 - y7 + y8) AS v11
      FROM l WHERE back > 90 GROUP BY family HAVING count(*) >= 80),
ch AS (SELECT family, CASE WHEN v00 = m THEN 0 WHEN v10 = m THEN 1 WHEN v01 = m THEN 0 ELSE 1 END AS d,
              CASE WHEN v00 = m OR v10 = m THEN 0 ELSE 1 END AS sd FROM (SELECT *, least(v00, v10, v01, v11) AS m FROM v)),
df AS (SELECT l.family,
              y - d * y1 - sd * y7 + d * sd * y8 AS w, a0 - d * a1 - sd * a7 + d * sd * a8 AS a,
              h0 - d * h1 - sd * h7 + d * sd * h8 AS h, o0 - d * o1 - sd * o7 + d * sd * o8 AS o
       FROM l JOIN ch ON l.family = ch.family WHERE back > 90 AND pos > d + 7 * sd + 21 + 14),
mo AS (SELECT family, count(*) AS n, var_pop(a) AS a, covar_pop(a, h) AS b, covar_pop(a, o) AS c, var_pop(h) AS d,
              covar_pop(h, o) AS e, var_pop(o) AS f, covar_pop(w, a) AS u, covar_pop(w, h) AS v, covar_pop(w, o) AS w,
              var_pop(w) AS s FROM df GROUP BY family),
be AS (SELECT *, (u*(d*f-e*e) - b*(v*f-e*w) + c*(v*e-d*w)) / det AS b1, (a*(v*f-e*w) - u*(b*f-c*e) + c*(b*w-c*v)) / det AS b2,
              (a*(d*w-v*e) - b*(b*w-c*v) + u*(b*e-c*d)) / det AS b3
       FROM (SELECT *, a*(d*f-e*e) - b*(b*f-c*e) + c*(b*e-c*d) AS det FROM mo))"""


@query("m12_arx_no_lags_aic", more(NO_LAGS, """
SELECT family, round(n * ln(s - b1*u - b2*v - b3*w) + 8, 6) AS aic, round(sqrt((s - b1*u - b2*v - b3*w) * n / (n - 4)), 6) AS sigma FROM be"""))
def _(spark, sf):
    table = arx.candidates(arx.prepare(daily(spark, sf), 90))
    return round_all(table.where("p + q + sp + sq = 0").select("family", "aic", "sigma"))


@query("m12_seasonal_arx")
def _(spark, sf):
    return round_all(arx.seasonal_arx(daily(spark, sf))[0])


@query("m12_arx_candidates")
def _(spark, sf):
    table = arx.candidates(arx.prepare(daily(spark, sf), 90))
    return round_all(table.select("family", "p", "q", "sp", "sq", "aic", "sigma"))


@query("m12_arx_group_report")
def _(spark, sf):
    panel = panel_table(spark, sf, oil=True)
    forecast, orders = arx.seasonal_arx(daily(spark, sf, panel))
    return reports.arx_report(joins.with_segment(forecast, segments(spark, sf, panel), how="inner"), orders)


@query("m13_additive_forecast")
def _(spark, sf):
    return round_all(additive.additive_forecast(daily(spark, sf))[0])


@query("m13_additive_report")
def _(spark, sf):
    panel = panel_table(spark, sf, oil=True)
    forecast, _ = additive.additive_forecast(daily(spark, sf, panel))
    means = panel.groupBy("family").agg(F.avg("sales").alias("mean_sales"))
    return reports.additive_report(joins.with_segment(forecast, segments(spark, sf, panel), how="inner"), means)


@query("m14_components")
def _(spark, sf):
    return round_all(additive.additive_forecast(daily(spark, sf))[1])
