"""Shared SQL of the oracles: the panel and what is derived from it, as DuckDB CTEs."""

from __future__ import annotations

PANEL = """
WITH li AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date,
         CAST(s.s_nationkey % 8 AS INT) AS store_nbr,
         p.p_type AS family, l.l_orderkey, l.l_quantity, l.l_discount, l.l_returnflag
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey),
tx AS (
  SELECT date, store_nbr, CAST(COUNT(DISTINCT l_orderkey) AS DOUBLE) AS transactions
  FROM li GROUP BY date, store_nbr),
oil AS (
  SELECT CAST(o_orderdate AS DATE) AS oil_date, MAX(o_totalprice) / 1000 AS oil
  FROM orders GROUP BY CAST(o_orderdate AS DATE)),
base AS (
  SELECT date, store_nbr, family,
         SUM(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0.0E0 END) AS sales,
         CAST(SUM(CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END) AS INT) AS onpromotion
  FROM li GROUP BY date, store_nbr, family),
panel AS (
  SELECT base.date, base.store_nbr, base.family, base.sales, base.onpromotion, tx.transactions,
         CONCAT('city_', CAST(base.store_nbr AS VARCHAR(8))) AS city,
         CONCAT('state_', CAST(base.store_nbr % 3 AS VARCHAR(8))) AS state,
         CONCAT('type_', CAST(base.store_nbr % 5 AS VARCHAR(8))) AS type,
         CAST(base.store_nbr % 4 AS INT) AS cluster,
         CASE WHEN isodow(base.date) >= 6 THEN NULL ELSE oil.oil END AS dcoilwtico,
         CASE WHEN day(base.date) = 1 THEN 1 ELSE 0 END AS is_holiday,
         CAST(isodow(base.date) - 1 AS INT) AS day_of_week,
         CAST(weekofyear(base.date) AS INT) AS week_of_year,
         CAST(month(base.date) AS INT) AS month,
         CAST(year(base.date) AS INT) AS year,
         CASE WHEN isodow(base.date) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM base
  JOIN tx ON base.date = tx.date AND base.store_nbr = tx.store_nbr
  LEFT JOIN oil ON base.date = oil.oil_date),
feat AS (
  SELECT *,
         lag(sales, 7) OVER w AS sales_lag_7, lag(sales, 14) OVER w AS sales_lag_14,
         lag(sales, 30) OVER w AS sales_lag_30,
         CASE WHEN count(sales) OVER w7 = 7 THEN avg(sales) OVER w7 END AS rolling_mean_7,
         CASE WHEN count(sales) OVER w30 = 30 THEN avg(sales) OVER w30 END AS rolling_mean_30,
         CASE WHEN count(sales) OVER w7 = 7 THEN stddev_samp(sales) OVER w7 END AS rolling_std_7,
         CASE WHEN count(sales) OVER w30 = 30 THEN stddev_samp(sales) OVER w30 END AS rolling_std_30
  FROM panel
  WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date),
         w7 AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         w30 AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
seg AS (
  SELECT family, CASE WHEN r <= 2 THEN 'High' WHEN r <= 4 THEN 'Medium'
                      WHEN r = 5 THEN 'Low' ELSE 'Ultra-low' END AS segment
  FROM (SELECT family, row_number() OVER (ORDER BY SUM(sales) DESC, family) AS r
        FROM panel GROUP BY family)),
folds(fold, train_start, train_end, test_start, test_end) AS (
  VALUES (1, DATE '1997-01-01', DATE '1999-12-31', DATE '2000-01-01', DATE '2000-03-31'),
         (2, DATE '1997-01-01', DATE '2000-03-31', DATE '2000-04-01', DATE '2000-06-30'),
         (3, DATE '1997-01-01', DATE '2000-06-30', DATE '2000-07-01', DATE '2000-09-30'),
         (4, DATE '1997-01-01', DATE '2000-09-30', DATE '2000-10-01', DATE '2000-12-31'),
         (5, DATE '1997-01-01', DATE '2000-12-31', DATE '2001-01-01', DATE '2001-03-31')),
oof AS (
  SELECT f.date, f.store_nbr, f.family, folds.fold, seg.segment, f.sales AS y_true,
         f.sales_lag_7 AS y_pred, floor(f.rolling_mean_30 * 8) / 8 AS y_pred_mean
  FROM feat f
  JOIN folds ON f.date BETWEEN folds.test_start AND folds.test_end
  LEFT JOIN seg ON f.family = seg.family
  WHERE f.sales_lag_7 IS NOT NULL AND f.rolling_mean_30 IS NOT NULL),
rollup_daily AS (
  SELECT family, date, COALESCE(SUM(sales), 0) AS sales,
         CAST(COALESCE(SUM(onpromotion), 0) AS BIGINT) AS onpromotion,
         MAX(is_holiday) AS is_holiday, AVG(dcoilwtico) AS dcoilwtico
  FROM panel GROUP BY family, date)
"""


def rounded(columns: list[str], digits: int = 6) -> str:
    """``* REPLACE (round(..))`` for the given columns."""
    parts = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in columns)
    return f"* REPLACE ({parts})"


def sql(body: str) -> str:
    """A query over the shared CTEs."""
    return f"{PANEL} {body}"


def more(ctes: str, body: str) -> str:
    """A query with further CTEs after the shared ones."""
    return f"{PANEL}, {ctes} {body}"


def sql_rounded(body: str, columns: list[str], digits: int = 6, ctes: str | None = None) -> str:
    """A query over the shared CTEs with some columns rounded."""
    head = PANEL if ctes is None else f"{PANEL}, {ctes}"
    return f"{head} SELECT {rounded(columns, digits)} FROM ({body})"
