"""Lags, rolling statistics, sequences, gap filling and interpolation of series.

All windows partition by the series key. A panel holds at most one row per series and
day, so a window partition is as long as the calendar (thousands of rows) no matter how
many rows the panel has; the operators rely on that key being unique and
``duplicate_keys`` reports rows that break it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SERIES = ["store_nbr", "family"]

Feature = tuple[str, Callable[[WindowSpec], Column]]


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row; empty for a proper panel."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def add_lags(lags: list[int], value: str = "sales") -> list[Feature]:
    """Value k rows back in the series (rows, not days)."""
    return [(f"{value}_lag_{k}", lambda w, k=k: F.lag(value, k).over(w)) for k in lags]


def add_rolling(sizes: list[int], stat: str, value: str = "sales") -> list[Feature]:
    """Mean or sample deviation of the previous k rows; null until k rows exist."""
    aggregate = {"mean": F.avg, "std": F.stddev_samp}[stat]

    def feature(k: int) -> Feature:
        def build(w: WindowSpec) -> Column:
            frame = w.rowsBetween(-k, -1)
            return F.when(F.count(value).over(frame) == k, aggregate(value).over(frame))

        return f"rolling_{stat}_{k}", build

    return [feature(k) for k in sizes]


def series_select(df: DataFrame, features: list[Feature], keys: list[str] = SERIES,
                  date: str = "date") -> DataFrame:
    """Add all features in one projection: one shuffle and one sort for the lot."""
    w = Window.partitionBy(*keys).orderBy(date)
    return df.select("*", *[build(w).alias(name) for name, build in features])


def make_sequences(df: DataFrame, columns: list[str], length: int = 30,
                   keys: list[str] = SERIES, date: str = "date",
                   target: str = "sales") -> DataFrame:
    """The ``length`` rows before each row as an array of feature arrays.

    A series of ``length`` rows or fewer yields nothing.
    """
    w = Window.partitionBy(*keys).orderBy(date)
    step = F.array(*[F.col(c).cast("double") for c in columns])
    return (
        df.select(*keys, date, F.col(target).alias("target"),
                  F.collect_list(step).over(w.rowsBetween(-length, -1)).alias("sequence"),
                  (F.row_number().over(w) > length).alias("full"))
        .where("full")
        .drop("full")
    )


def fill_calendar(df: DataFrame, keys: list[str], zero: list[str],
                  date: str = "date") -> DataFrame:
    """One row per key and day between the key's first and last day.

    Each row is stretched to the day before its successor, so the gap rows need no
    calendar table and no join. ``zero`` columns are 0 on the added days, all others
    null.
    """
    w = Window.partitionBy(*keys).orderBy(date)
    upto = F.coalesce(F.date_sub(F.lead(date).over(w), 1), F.col(date))
    others = [c for c in df.columns if c not in [*keys, date]]
    days = (
        df.withColumn("__upto", upto)
        .select("*", F.explode(F.sequence(F.col(date), F.col("__upto"))).alias("__day"))
    )
    real = F.col("__day") == F.col(date)

    def filled(c: str) -> Column:
        if c in zero:
            return F.when(real, F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0)).alias(c)
        return F.when(real, F.col(c)).alias(c)

    return days.select(*keys, F.col("__day").alias(date), *[filled(c) for c in others])


def interpolate(df: DataFrame, value: str, keys: list[str], date: str = "date") -> DataFrame:
    """Linear interpolation in time; the ends take the nearest value, no value gives 0."""
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(date).alias("d"), F.col(value).alias("v")))
    # The next known value comes from the same growing frame over the reversed order: a
    # frame to the end of the partition would be recomputed for every row.
    back = Window.partitionBy(*keys).orderBy(F.desc(date)).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    both = df.withColumn("__k", known).select(
        "*",
        F.last("__k", ignorenulls=True).over(ahead).alias("__p"),
        F.last("__k", ignorenulls=True).over(back).alias("__n"),
    )
    span = F.datediff(F.col("__n.d"), F.col("__p.d"))
    step = F.datediff(F.col(date), F.col("__p.d"))
    slope = F.try_divide((F.col("__n.v") - F.col("__p.v")) * step, span)
    line = F.when(F.col(value).isNotNull(), F.col(value)).otherwise(F.col("__p.v") + slope)
    filled = F.coalesce(line, F.col("__p.v"), F.col("__n.v"), F.lit(0.0))
    return both.withColumn(value, filled).drop("__k", "__p", "__n")


def holdout_last(df: DataFrame, rows: int, keys: list[str], date: str = "date") -> DataFrame:
    """Mark the last ``rows`` rows of each series as test; shorter series are dropped."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(date))
    size = Window.partitionBy(*keys)
    return (
        df.select("*", F.row_number().over(newest).alias("__r"), F.count(F.lit(1)).over(size).alias("__n"))
        .where(F.col("__n") > rows)
        .withColumn("is_test", F.col("__r") <= rows)
        .drop("__r", "__n")
    )


def tail_rows(df: DataFrame, rows: int, keys: list[str], date: str = "date") -> DataFrame:
    """The last ``rows`` rows of each series."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(date))
    return df.withColumn("__r", F.row_number().over(newest)).where(F.col("__r") <= rows).drop("__r")
