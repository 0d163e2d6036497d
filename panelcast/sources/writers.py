"""Writers: reports, folds, scenario files, state and the shared comparison table."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.functions.columns import safe_name


def formatted(df: DataFrame, digits: int = 4, fixed: bool = True) -> DataFrame:
    """Doubles as text with fixed digits, or rounded and left as numbers; nulls stay null."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    if fixed:
        return df.withColumns({
            c: F.when(F.col(f"`{c}`").isNotNull(), F.format_string(f"%.{digits}f", F.col(f"`{c}`"))) for c in doubles})
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles})


def as_text_cells(df: DataFrame) -> DataFrame:
    """Arrays as text like (1, 0, 2): CSV holds flat cells only."""
    arrays = [c for c, t in df.dtypes if t.startswith("array")]
    return df.withColumns({
        c: F.concat(F.lit("("), F.concat_ws(", ", F.transform(c, lambda x: x.cast("string"))), F.lit(")"))
        for c in arrays
    })


def write_report(df: DataFrame, path: str, digits: int = 4, fixed: bool = True) -> str:
    """One CSV file for a report, which has a row per family, fold or model."""
    formatted(as_text_cells(df), digits, fixed).coalesce(1).write.option("header", True).csv(path)
    return path


def write_folds(df: DataFrame, path: str) -> str:
    """Fold rows by folder, so a reader of one fold opens only its files."""
    df.write.partitionBy("fold", "split").option("maxRecordsPerFile", 5_000_000).parquet(path)
    return path


def write_fold_files(df: DataFrame, folder: str, ids: list[int]) -> str:
    """Folds as train_fold_i.csv / test_fold_i.csv."""
    for i in ids:
        for split in ("train", "test"):
            part = df.where((F.col("fold") == i) & (F.col("split") == split)).drop("fold", "split")
            part.write.option("header", True).csv(f"{folder}/{split}_fold_{i}.csv")
    return folder


def write_scenarios(df: DataFrame, path: str) -> str:
    """What-if rows in folders named by family and scenario."""
    named = df.withColumns({"family_name": F.col("family"), "family": safe_name("family")})
    named.write.partitionBy("family", "scenario").option("header", True).csv(path)
    return path


def save_state(state: DataFrame | PipelineModel, path: str) -> str:
    """Encoder, scaler and scale tables as Parquet, fitted pipelines in the ML format."""
    if isinstance(state, DataFrame):
        state.write.mode("overwrite").parquet(path)
    else:
        state.write().overwrite().save(path)
    return path


def load_state(spark: SparkSession, path: str) -> DataFrame | PipelineModel:
    """A pipeline where one was saved, else a table."""
    try:
        return PipelineModel.load(path)
    except Exception as not_a_pipeline:
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            raise not_a_pipeline


def upsert_by(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows whose key is not in ``new``, and all new rows."""
    kept = old.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


# Markers of a stored table's versions: number -> folder of its rows and their schema.
COMMITS = "_commits"


def _files(spark: SparkSession, path: str):
    """(file context, path object) of a path, whatever store it is in."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place = place.getFileSystem(conf).makeQualified(place)
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf), place


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    files, folder = _files(spark, f"{base}/{COMMITS}")
    if not files.util().exists(folder):
        return []
    names = [status.getPath().getName() for status in files.util().listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def read_version(spark: SparkSession, base: str, version: int) -> DataFrame:
    """The rows of one committed version."""
    marker = spark.read.text(f"{base}/{COMMITS}/{version:010d}", wholetext=True).first()[0]
    folder, schema = marker.split("\n", 1)
    return spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{base}/{folder}")


def commit(spark: SparkSession, base: str, version: int, folder: str, schema: StructType) -> bool:
    """Name ``folder`` as a version; false if another writer has that version already.

    The marker is written whole under another name and then renamed, and a rename never
    replaces a marker that stands there.
    """
    draft = f"{base}/{COMMITS}/draft-{uuid.uuid4().hex}"
    files, source = _files(spark, draft)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    out = source.getFileSystem(spark._jsc.hadoopConfiguration()).create(source, False)
    out.write(bytearray(f"{folder}\n{schema.json()}".encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.NONE
    _, target = _files(spark, f"{base}/{COMMITS}/{version:010d}")
    try:
        files.rename(source, target, options)
        return True
    except Py4JJavaError as error:
        if not error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise
        files.delete(source, False)
        return False


def latest(spark: SparkSession, base: str) -> tuple[DataFrame | None, int]:
    """Newest committed version of an upserted table and its number (none: 0)."""
    known = versions(spark, base)
    return (read_version(spark, base, known[-1]), known[-1]) if known else (None, 0)


def upsert_table(spark: SparkSession, base: str, new: DataFrame, key: str) -> DataFrame:
    """Replace one key's rows in a stored table; the version that holds them.

    Rows go to a folder of their own, and a marker that names the folder makes them a version.
    A failed run leaves a folder that no marker names, so it changes nothing and is in nobody's
    way. A writer that finds its version taken merges with that version's rows and tries again,
    so writers at the same time lose no rows; an empty table is a version too.
    """
    while True:
        old, version = latest(spark, base)
        merged = new if old is None else upsert_by(old, new, key)
        folder = f"rows-{uuid.uuid4().hex}"
        merged.write.parquet(f"{base}/{folder}")
        if commit(spark, base, version + 1, folder, merged.schema):
            return read_version(spark, base, version + 1)
