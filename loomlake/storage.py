"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a temporary folder on a local master, and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if path is None:
        path = getattr(spark.sparkContext, "_loomlake_dir", None)
        if path is None:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            path = spark.sparkContext._loomlake_dir = "file://" + tempfile.mkdtemp(prefix="loomlake-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


ROWS_A_FILE = 100_000


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Compute once, keep in the shared folder and forget the lineage; survives lost executors.

    ``rows``: at most so many narrow rows, which are written in a file for each ``ROWS_A_FILE`` at most instead of one for each partition.
    """
    shared_dir(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, file: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*done: DataFrame) -> None:
    """Delete what :func:`cut` wrote for tables that nothing will read again."""
    for df in done:
        remove(df.sparkSession, df._jdf.queryExecution().logical().rdd().getCheckpointFile().get())


def exists(spark: SparkSession, file: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
