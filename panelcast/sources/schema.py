"""Checks and clean-up of frames whose columns vary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail, naming what is missing, unless all columns are there."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order: absent ones null, extra ones dropped."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return df.to(nullable)


def normalize_headers(df: DataFrame, names: list[str]) -> DataFrame:
    """Trim and lower all headers; a header that contains one of ``names`` becomes it."""
    taken: set[str] = set()
    clean = []
    for header in (c.strip().lower() for c in df.columns):
        match = next((n for n in names if n in header and n not in taken), None)
        if match is not None:
            taken.add(match)
        clean.append(match or header)
    return df.toDF(*clean)
