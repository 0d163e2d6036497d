"""Tables of the corpus and tables written between passes.

Intermediate tables lie under ``spark.checkpoint.dir`` (see ``panelcast.session``), so a
lost executor costs a re-read, never a wrong row. ``drop`` removes one that no later step
reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.session import new_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Written:
    """A table that was written once, ``by`` a column in folders if one is named; ``df`` reads it, ``drop`` removes
    it or one of its folders."""

    def __init__(self, df: DataFrame, name: str, by: str | None = None):
        self.spark = df.sparkSession
        self.path = new_path(self.spark, name)
        df.write.parquet(self.path, partitionBy=by)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self, folder: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


class Bucketed:
    """A table that grows by ``append``, bucketed by a column: joins on it shuffle the other side only."""

    def __init__(self, spark: SparkSession, key: str, buckets: int, name: str):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.path = new_path(spark, name)
        self.table = self.path.rsplit("/", 1)[1].replace("-", "_")

    def append(self, df: DataFrame) -> None:
        dealt = df.repartition(self.buckets, self.key)
        # The packed form of this version suits sorted numbers.
        dealt = dealt.write.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
        dealt.bucketBy(self.buckets, self.key).option("path", self.path).mode("append").saveAsTable(self.table)

    @property
    def df(self) -> DataFrame:
        return self.spark.table(self.table)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.table}")
        Written.drop(self)
