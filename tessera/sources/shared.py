"""Storage that the driver and all executors share: lineage cuts and tables of one run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); a temporary one only where none is set and Spark runs in one process, as in tests."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if (sc.master or "").split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def _tidy(spark: SparkSession, run):
    """What run() gives; the shuffle files of the frames made in it are removed at once."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        return run()
    finally:
        spark.conf.set(_CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in shared storage, so that a lost executor loses none of it."""
    shared_dir(df.sparkSession)
    return _tidy(df.sparkSession, lambda: df.select("*").checkpoint(eager=True))


def folder(spark: SparkSession, name: str) -> str:
    """A new path in shared storage."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df, written to a folder of its own in shared storage, and that folder."""
    path = folder(df.sparkSession, name)
    _tidy(df.sparkSession, lambda: df.select("*").write.parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, *paths: str) -> None:
    """Removes folders that table() or folder() gave."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
