"""Row-level features: calendar, promotion, flags, weights, null handling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def between_dates(df: DataFrame, lo: str | None = None, hi: str | None = None,
                  date: str = "date") -> DataFrame:
    """Closed date range; either end may be open. Reaches the Parquet scan."""
    if lo is not None:
        df = df.where(F.col(date) >= F.lit(lo).cast("date"))
    if hi is not None:
        df = df.where(F.col(date) <= F.lit(hi).cast("date"))
    return df


def before_date(df: DataFrame, cut: str, date: str = "date") -> DataFrame:
    """Rows strictly before the cut."""
    return df.where(F.col(date) < F.lit(cut).cast("date"))


def calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    """ISO calendar parts: Monday is 0, weekend is Saturday and Sunday."""
    return df.withColumns({
        "day_of_week": F.weekday(date).cast("int"),
        "week_of_year": F.weekofyear(date).cast("int"),
        "month": F.month(date).cast("int"),
        "year": F.year(date).cast("int"),
        "is_weekend": F.when(F.weekday(date) >= 5, 1).otherwise(0),
    })


def ensure_month(df: DataFrame, date: str = "date") -> DataFrame:
    """Add ``month`` only where the frame does not carry it."""
    return df if "month" in df.columns else df.withColumn("month", F.month(date).cast("int"))


def add_promo_interactions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "promo_weekend": F.col("onpromotion") * F.col("is_weekend"),
        "promo_holiday": F.col("onpromotion") * F.col("is_holiday"),
    })


def add_flag(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """0/1 column; an unknown condition counts as 0."""
    return df.withColumn(name, F.when(condition, 1).otherwise(0))


def fill_constants(df: DataFrame, numeric: float | None = 0, text: str | None = None,
                   subset: list[str] | None = None) -> DataFrame:
    """Constant null fill by type.

    With ``text=None`` a string column is filled with the text of the number.
    """
    values: dict[str, object] = {}
    for field in df.schema.fields:
        if subset is not None and field.name not in subset:
            continue
        if isinstance(field.dataType, T.StringType):
            values[field.name] = text if text is not None else str(numeric)
        elif isinstance(field.dataType, T.NumericType) and numeric is not None:
            values[field.name] = numeric
    return df.na.fill(values) if values else df


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any, or in the named, columns."""
    return df.na.drop(how="any", subset=subset)


def null_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Those columns that hold a null; one aggregate over the frame."""
    if not columns:
        return []
    row = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column, so that aggregates skip it."""
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def year_weight(df: DataFrame, weights: dict[int, float], name: str = "weight") -> DataFrame:
    """Row weight by year; 1.0 for a year not named."""
    weight = reduce(
        lambda acc, item: F.when(F.col("year") == item[0], F.lit(float(item[1]))).otherwise(acc),
        weights.items(),
        F.lit(1.0),
    )
    return df.withColumn(name, weight)


def select_existing(df: DataFrame, candidates: list[str]) -> DataFrame:
    """Those candidates the frame has, in the order given."""
    return df.select(*[c for c in candidates if c in df.columns])


def features_of(df: DataFrame, exclude: list[str]) -> list[str]:
    """All columns but the excluded ones and any prediction left in the frame."""
    leaked = {"sales_true", "sales_pred", "fold"}
    return [c for c in df.columns if c not in set(exclude) | leaked]


def split_features(df: DataFrame, exclude: list[str]) -> tuple[list[str], list[str]]:
    """(numeric and boolean columns, string columns) outside ``exclude``."""
    numeric, text = [], []
    for field in df.schema.fields:
        if field.name in exclude:
            continue
        if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            numeric.append(field.name)
        elif isinstance(field.dataType, T.StringType):
            text.append(field.name)
    return numeric, text


def promo_scenarios(df: DataFrame) -> DataFrame:
    """Each row under two scenarios: promotion on everywhere, and promotion off.

    One pass: the two overrides sit in an array of structs that is exploded, so the
    frame is not read twice and nothing is shuffled.
    """
    def override(name: str, flag: float, weekend: Column, holiday: Column) -> Column:
        return F.struct(
            F.lit(name).alias("scenario"),
            F.lit(flag).alias("onpromotion"),
            weekend.cast("double").alias("promo_weekend"),
            holiday.cast("double").alias("promo_holiday"),
        )

    replaced = ["onpromotion", "promo_weekend", "promo_holiday", "scenario"]
    kept = [c for c in df.columns if c not in replaced]
    scenarios = F.array(
        override("with_promo", 1.0, F.col("is_weekend"), F.col("is_holiday")),
        override("no_promo", 0.0, F.lit(0.0), F.lit(0.0)),
    )
    return df.select(*kept, F.explode(scenarios).alias("s")).select(*kept, "s.*")
