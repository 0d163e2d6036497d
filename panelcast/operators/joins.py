"""Dimension joins of the panel.

No join carries a broadcast hint: a dimension that is read from files has a known size,
and the planner broadcasts it when it is below ``spark.sql.autoBroadcastJoinThreshold``
and shuffles (with the adaptive skew split) when it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_segment(df: DataFrame, segments: DataFrame, how: str = "left",
                 only_if_absent: bool = False) -> DataFrame:
    """Attach the segment of the family; ``how='inner'`` keeps known families only."""
    if only_if_absent and "segment" in df.columns:
        return df
    return df.drop("segment").join(segments.select("family", "segment"), "family", how)


def in_segment(df: DataFrame, segments: DataFrame, names: list[str],
               negate: bool = False) -> DataFrame:
    """Rows whose family is (or is not) in one of the segments."""
    wanted = segments.where(F.col("segment").isin(names)).select("family")
    return df.join(wanted, "family", "left_anti" if negate else "left_semi")


def in_families(df: DataFrame, families: list[str], negate: bool = False) -> DataFrame:
    """Rows of the named families; a literal list stays a pushed-down predicate."""
    member = F.col("family").isin(families)
    return df.where(~member) if negate else df.where(member)


def map_weight(df: DataFrame, weights: DataFrame, key: str = "family", default: float = 1.0) -> DataFrame:
    """Look up ``weight`` by key; a key without one gets the default."""
    return df.join(weights.select(key, "weight"), key, "left").withColumn(
        "weight", F.coalesce(F.col("weight"), F.lit(default))
    )


def attach(df: DataFrame, predictions: DataFrame, keys: list[str]) -> DataFrame:
    """Put predictions back on their rows by the panel key, never by row position."""
    return df.join(predictions, keys, "left")
