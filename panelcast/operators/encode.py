"""Label, ordinal and one-hot encoders, imputation by mode, and scalers.

A fitted encoder or scaler is a small table; applying it is a join or arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.aggregates import most_frequent
from panelcast.operators.ranking import ordinal
from panelcast.session import materialize


def as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def fit_label(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, code): 0-based position in text order, for all columns at once."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    values = df.select(cells.alias("s")).select("s.*").where("value is not null")
    return ordinal(values, ["feature"], "value", "code")


def fit_ordinal(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, code) in each column's own order: whole numbers as numbers, text as text."""
    kinds = dict(df.dtypes)
    text = [c for c in columns if kinds[c] == "string"]
    numbers = [c for c in columns if c not in text]

    def coded(names: list[str], kind: str) -> DataFrame:
        cells = F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast(kind).alias("value")) for c in names
        ]))
        values = df.select(cells.alias("s")).select("s.*").where("value is not null")
        return ordinal(values, ["feature"], "value", "code").withColumn("value", F.col("value").cast("string"))

    parts = [coded(names, kind) for names, kind in ((text, "string"), (numbers, "bigint")) if names]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def fit_label_native(df: DataFrame, column: str) -> DataFrame:
    """(value, code) with positions in the column's own order, numbers as numbers."""
    values = df.select(F.lit(column).alias("feature"), F.col(column).alias("value")).where("value is not null")
    return ordinal(values, ["feature"], "value", "code").select("value", "code")


def apply_label(df: DataFrame, mapping: DataFrame, columns: list[str], unknown: int | None = None) -> DataFrame:
    """Replace columns by their codes; an unseen value gives ``unknown`` (null by default)."""
    for c in columns:
        codes = mapping.where(F.col("feature") == c).select(F.col("value").alias("__v"), F.col("code").alias("__c"))
        df = df.join(codes, F.col(c).cast("string") == F.col("__v"), "left")
        code = F.col("__c") if unknown is None else F.coalesce(F.col("__c"), F.lit(unknown))
        df = df.withColumn(c, code.cast("int")).drop("__v", "__c")
    return df


def apply_label_native(df: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    codes = mapping.select(F.col("value").alias("__v"), F.col("code").alias("__c"))
    joined = df.join(codes, F.col(column) == F.col("__v"), "left")
    return joined.withColumn(column, F.col("__c")).drop("__v", "__c")


def decode(df: DataFrame, mapping: DataFrame, column: str, name: str) -> DataFrame:
    """Add the text behind a code column."""
    codes = mapping.where(F.col("feature") == column).select(
        F.col("code").alias(column), F.col("value").alias(name)
    )
    return df.join(codes, column, "left")


def distinct_union(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """Domain of an encoder fitted on train and test together."""
    return train.select(F.col(column).alias("value")).union(test.select(column)).distinct()


def impute_most_frequent(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill nulls of text columns with the most frequent value (one value per column)."""
    modes = most_frequent(df if fit_on is None else fit_on, columns)
    values = {r["feature"]: r["value"] for r in modes.collect()}
    return df.na.fill({c: v for c, v in values.items() if v is not None})


def one_hot(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """One 0/1 column per known category; an unknown value is 0 in all of them."""
    flags: dict[str, Column] = {
        v: F.when(F.col(c) == v, 1).otherwise(0) for c, values in categories.items() for v in values
    }
    return df.withColumns(flags)


def index_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_ix`` codes for tree learners."""
    mapping = materialize(fit_label(df, columns), "codes")
    coded = df.withColumns({f"{c}_ix": F.col(c) for c in columns})
    for c in columns:
        named = mapping.where(F.col("feature") == c).withColumn("feature", F.lit(f"{c}_ix"))
        coded = apply_label(coded, named, [f"{c}_ix"], unknown=-1)
    return coded


def minmax(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Scale to [0, 1] by the extremes of ``fit_on`` (all rows by default); constant gives 0."""
    source = df if fit_on is None else fit_on
    extremes = source.agg(*[f(c).alias(f"__{k}_{c}") for c in columns for k, f in (("lo", F.min), ("hi", F.max))])
    row = extremes.first()

    def scaled(c: str) -> Column:
        lo, hi = row[f"__lo_{c}"], row[f"__hi_{c}"]
        if lo is None or hi == lo:
            return F.when(F.col(c).isNotNull(), 0.0)
        return (F.col(c) - F.lit(float(lo))) / F.lit(float(hi) - float(lo))

    return df.withColumns({c: scaled(c) for c in columns})


def standardize(df: DataFrame, columns: list[str], by: list[str] = (), fit_on: DataFrame | None = None) -> DataFrame:
    """Subtract the mean and divide by the population deviation (1 where it is 0)."""
    source = df if fit_on is None else fit_on
    aggregates = [f(c).alias(f"__{k}_{c}") for c in columns for k, f in (("m", F.avg), ("s", F.stddev_pop))]
    stats = materialize(source.groupBy(*by, F.lit(1).alias("__all")).agg(*aggregates), "scaler")
    joined = df.withColumn("__all", F.lit(1)).join(stats, [*by, "__all"])

    def scaled(c: str) -> Column:
        scale = F.when(F.col(f"__s_{c}") == 0, 1.0).otherwise(F.col(f"__s_{c}"))
        return (F.col(c) - F.col(f"__m_{c}")) / scale

    return joined.withColumns({c: scaled(c) for c in columns}).drop(
        "__all", *[f"__{k}_{c}" for c in columns for k in ("m", "s")]
    )
