"""Readers: panel, segments, fold pairs, tagged files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.operators.features import nan_to_null
from panelcast.sources.schema import normalize_headers, require_columns

# The known columns of a panel and their types.
PANEL_TYPES = {
    "date": "date", "store_nbr": "int", "family": "string", "sales": "double", "onpromotion": "int",
    "transactions": "double", "city": "string", "state": "string", "type": "string", "cluster": "int",
    "dcoilwtico": "double", "is_holiday": "int", "is_weekend": "int", "day_of_week": "int",
    "week_of_year": "int", "month": "int", "year": "int", "sales_lag_7": "double",
    "sales_lag_14": "double", "sales_lag_28": "double", "sales_lag_30": "double",
    "rolling_mean_7": "double", "rolling_mean_30": "double", "rolling_std_7": "double",
    "rolling_std_30": "double",
}
REQUIRED = ["date", "store_nbr", "family", "sales"]


def _csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Files of one layout: known columns get their type, others are read as text, without a pass
    over the data. A file whose header differs from the first one's raises."""
    reader = spark.read.option("header", True).option("sep", sep)
    names = reader.csv(path).columns
    schema = ", ".join(f"`{c}` {PANEL_TYPES.get(c, 'string')}" for c in names)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def _by_name(parts: list[DataFrame]) -> DataFrame:
    """All parts in one frame, columns matched by name; a column that a part lacks is null."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_panel(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
               fmt: str = "csv") -> DataFrame:
    """Panel from CSV (header, ISO dates) or Parquet; NaN becomes null.

    Paths may differ in the order and set of their columns; the files of a path may not.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "parquet":
        df = _by_name([spark.read.parquet(p) for p in paths])
    elif schema is not None:
        df = spark.read.options(header=True, enforceSchema=False).schema(schema).csv(paths)
    else:
        df = _by_name([_csv(spark, p) for p in paths])
    require_columns(df, REQUIRED)
    return nan_to_null(df)


def sniff_separator(spark: SparkSession, path: str) -> str:
    """The separator of a file, from its header line."""
    header = spark.read.text(path).first()
    line = header[0] if header else ""
    return max([",", ";", "\t"], key=line.count)


def read_segments(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """(family, segment) from a file with either separator and untidy headers."""
    sep = sep or sniff_separator(spark, path)
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    tidy = normalize_headers(raw, ["family", "segment"])
    require_columns(tidy, ["family", "segment"])
    # Both spellings of the lowest segment are in use.
    segment = F.when(F.col("segment") == "Ultra Low", "Ultra-low").otherwise(F.col("segment"))
    return tidy.select("family", segment.alias("segment"))


def read_folds(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """All fold pairs, tagged with fold and split; a fold without both files is left out.

    Columns are matched by name, so files may differ in their order and set.
    """
    parts = []
    for i in ids:
        try:
            pair = [(split, _csv(spark, f"{folder}/{split}_fold_{i}.csv")) for split in ("train", "test")]
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            continue
        parts += [df.withColumns({"fold": F.lit(i), "split": F.lit(split)}) for split, df in pair]
    if not parts:
        raise FileNotFoundError(f"no fold pair of {ids} in {folder}")
    return _by_name(parts)


def read_fold_table(spark: SparkSession, path: str) -> DataFrame:
    """Folds written by ``write_folds``; filters on fold and split skip whole folders."""
    return spark.read.parquet(path)


def read_tagged(spark: SparkSession, files: dict[str, object], tag: str = "model", sep: str = ",",
                on_missing: str = "skip", rename: dict[str, str] | None = None) -> DataFrame:
    """Small report files with differing columns as one frame, each row tagged.

    A file that is not there, or cannot be read, is skipped (``on_missing='skip'``) or
    raises. Columns a file lacks are null.
    """
    out = None
    for path, value in files.items():
        try:
            part = spark.read.options(header=True, inferSchema=True, sep=sep).csv(path)
        except AnalysisException:
            if on_missing != "skip":
                raise
            continue
        for old, new in (rename or {}).items():
            part = part.withColumnRenamed(old, new)
        part = part.withColumn(tag, F.lit(value))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"none of {list(files)} could be read")
    return out


def read_matching(spark: SparkSession, folder: str, glob: str, tag: str, pattern: str, schema: str) -> DataFrame:
    """Files of one layout picked by name, tagged with the part of the path the pattern catches.

    Absent files simply do not match and broken ones are skipped.
    """
    rows = (
        spark.read.schema(schema)
        .options(header=True, recursiveFileLookup=True, pathGlobFilter=glob, ignoreCorruptFiles=True)
        .csv(folder)
    )
    return rows.withColumn(tag, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def find_inputs(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Paths of the files under ``root`` whose name matches; no file is opened."""
    return (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=glob)
        .load(root)
        .select("path", "length")
    )
