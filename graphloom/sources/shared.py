"""Tables in the folder that all executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}  # of each local application without the setting


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors see; a temporary one only where that is unset and Spark is local."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = _local.setdefault(spark.sparkContext.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="graphloom-")
        _local[spark.sparkContext.applicationId] = at
    return at.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """The application's own folder below it."""
    return f"{shared_dir(spark)}/graphloom-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, a job's shuffle files are deleted when the job ends; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Writes ``df`` into the application's folder and reads it back: cuts the lineage and survives lost executors. What was shuffled for it
    is deleted."""
    path = new_path(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    with shuffles_removed(df.sparkSession):
        writer.partitionBy(*partition_by).parquet(path) if partition_by else writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables as written() gave them, which nothing that is still to be computed reads."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all tables that written() made for this application. Results that are not stored elsewhere can no longer be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
