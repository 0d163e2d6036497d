"""Expanding-window folds and validation cuts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# (fold, first train day, last train day, first test day, last test day), days as text
Fold = tuple[int, str, str, str, str]
BOUNDS = ["train_start", "train_end", "test_start", "test_end"]


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def folds_table(spark: SparkSession, folds: list[Fold]) -> DataFrame:
    """Fold bounds as a table with one row per fold."""
    rows = [
        F.struct(F.lit(f[0]).alias("fold"), *[_day(d).alias(n) for n, d in zip(BOUNDS, f[1:])])
        for f in folds
    ]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("f")).select("f.*")


def assign_folds(df: DataFrame, folds: list[Fold], date: str = "date") -> DataFrame:
    """Each row once per fold and split it belongs to.

    A row lands in the training set of many folds and in the test set of at most one.
    The folds are literals, so this is a projection: nothing is joined or shuffled.
    """
    day = F.col(date)

    def member(f: Fold) -> Column:
        split = F.when(day.between(_day(f[1]), _day(f[2])), "train").when(
            day.between(_day(f[3]), _day(f[4])), "test"
        )
        return F.struct(F.lit(f[0]).alias("fold"), split.alias("split"))

    first = min(f[i] for f in folds for i in (1, 3))
    last = max(f[i] for f in folds for i in (2, 4))
    return (
        df.where(day.between(_day(first), _day(last)))
        .select("*", F.explode(F.array(*[member(f) for f in folds])).alias("__f"))
        .where("__f.split is not null")
        .select("*", "__f.fold", "__f.split")
        .drop("__f")
    )


def assign_test_fold(df: DataFrame, folds: list[Fold], date: str = "date") -> DataFrame:
    """Test rows only, with the fold they are scored in."""
    day = F.col(date)
    fold = reduce(
        lambda acc, f: F.when(day.between(_day(f[3]), _day(f[4])), F.lit(f[0])).otherwise(acc),
        folds,
        F.lit(None).cast("int"),
    )
    inside = day.between(_day(min(f[3] for f in folds)), _day(max(f[4] for f in folds)))
    return df.where(inside).withColumn("fold", fold).where("fold is not null")


def train_rows(df: DataFrame, fold: Fold, date: str = "date") -> DataFrame:
    return df.where(F.col(date).between(_day(fold[1]), _day(fold[2])))


def test_rows(df: DataFrame, fold: Fold, date: str = "date") -> DataFrame:
    return df.where(F.col(date).between(_day(fold[3]), _day(fold[4])))


def validation_cut(df: DataFrame, days: int = 30, fold: str = "fold", date: str = "date",
                   min_rows: int = 50) -> DataFrame:
    """Mark the last ``days`` days of each training set as validation.

    Where fewer than ``min_rows`` rows would validate, or none would be left to train
    on, nothing is marked. Cut date and row counts come from one count by fold and day.
    """
    daily = df.groupBy(fold, date).count()
    cuts = daily.groupBy(fold).agg(F.date_sub(F.max(date), days).alias("__cut"))
    late = F.col(date) > F.col("__cut")
    usable = (
        daily.join(F.broadcast(cuts), fold)
        .groupBy(fold, "__cut")
        .agg(F.sum(F.when(late, F.col("count")).otherwise(0)).alias("__val"),
             F.sum(F.when(late, 0).otherwise(F.col("count"))).alias("__rest"))
        .where((F.col("__val") >= min_rows) & (F.col("__rest") > 0))
        .select(fold, "__cut")
    )
    # One row per fold: broadcast, the fold key would be far too coarse to shuffle by.
    return df.join(F.broadcast(usable), fold, "left").withColumn(
        "is_validation", F.coalesce(late, F.lit(False))
    ).drop("__cut")
