"""Ranks, top-k and samples without pulling a whole frame into one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import join_null_safe
from panelcast.session import materialize


def rank_small(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Row number over a result with one row per family, model or fold."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def top_k(df: DataFrame, by: str, k: int, tie: list[str], ascending: bool = False) -> DataFrame:
    """First k rows by a column; ties go by key so that the result is fixed."""
    first = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return df.orderBy(first, *[F.asc(t) for t in tie]).limit(k)


def sample_n(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """n rows picked by a seeded hash of the key, the same on every run; all if fewer.

    The rows with the n smallest hashes win. Only rows below a hash bound that lets a
    few more than n pass are sorted, so the tasks do not each hand over n rows.
    """
    total = df.count()
    if total <= n:
        return df
    space = 1 << 53
    place = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(space))
    expected = n + 10 * math.sqrt(n) + 10
    near = df
    if expected < total:
        near = materialize(df.where(place < int(space * expected / total)), "sample")
        if near.count() < n:
            near = df
    return near.orderBy(place, *keys).limit(n)


# Rows a single sort takes; a group is cut into as many ranges as that asks for.
RANGE_ROWS = 2_000_000


def running_total(df: DataFrame, by: list[str], value: str, weight: Column, name: str,
                  range_rows: int = RANGE_ROWS) -> DataFrame:
    """Sum of ``weight`` over the group's rows up to and including this one, by ``value``.

    ``df`` must be materialized and hold each value once per group. Groups are cut at values
    chosen by hash into ranges of about ``range_rows`` rows; each range is summed by itself and
    starts where the ranges below it end.
    """
    keys = [*by, "__all"]
    rows = df.withColumns({"__all": F.lit(1), "__w": weight})
    largest = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    # The ranges differ in length: cut four times as often as equal ones would need.
    ranges = -(-largest // range_rows) * 4 if largest > range_rows else 1
    upto = Window.unboundedPreceding
    if ranges == 1:  # one range is the group itself
        w = Window.partitionBy(*keys).orderBy(value).rowsBetween(upto, 0)
        return rows.withColumn(name, F.sum("__w").over(w)).drop("__w", "__all")

    bucket = F.pmod(F.xxhash64(value), F.lit(ranges))
    cuts = (
        rows.groupBy(*keys, bucket.alias("__h"))
        .agg(F.min_by(value, F.xxhash64(F.lit(1), F.col(value))).alias("__c"))
        .groupBy(*keys)
        .agg(F.collect_list("__c").alias("__cuts"))
    )
    below = F.size(F.filter("__cuts", lambda c: c <= F.col(value)))
    ranged = materialize(
        join_null_safe(rows, materialize(cuts, "cuts"), keys).withColumn("__range", below).drop("__cuts"), "ranges"
    )
    sums = ranged.groupBy(*keys, "__range").agg(F.sum("__w").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(upto, -1)
    starts = sums.select(*keys, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*keys, "__range").orderBy(value).rowsBetween(upto, 0)
    return (
        ranged.withColumn("__s", F.sum("__w").over(inside))
        .transform(lambda part: join_null_safe(part, materialize(starts, "range_starts"), [*keys, "__range"]))
        .withColumn(name, F.col("__start") + F.col("__s"))
        .drop("__w", "__all", "__range", "__s", "__start")
    )


def ordinal(values: DataFrame, by: list[str], value: str, name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """0-based position of each distinct value within its group, in ascending order."""
    distinct = materialize(values.select(*by, value).distinct(), "domain")
    ranked = running_total(distinct, by, value, F.lit(1), "__upto", range_rows)
    return ranked.select(*by, value, (F.col("__upto") - 1).cast("int").alias(name))
