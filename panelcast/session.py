"""Session helpers: a local session for tests, and tables shared between passes."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app_name: str = "panelcast") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master without one may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="panelcast-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path under the shared folder; never an existing one."""
    return f"{shared_dir(spark)}/panelcast/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Operators that pass over their input several times use it so that each pass
    reads only the columns it needs and a lost executor re-reads files instead of
    recomputing the lineage. Small tables gain as well: the planner knows the size
    of what it reads and broadcasts it only when it is below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows dealt by key over as many tasks as the session shuffles to.

    For few rows that each take long, such as a system to solve per group: they weigh so
    little that the adaptive planner would put them all into one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
