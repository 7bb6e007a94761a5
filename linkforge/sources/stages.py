"""Durable intermediates in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session, or, where
    nothing is configured and all run in this machine's one process (tests), a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="linkforge-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def _files(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors. What
    ``discard`` has not deleted goes when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/linkforge/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    files, p = _files(spark, path)
    files.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._linkforge_path = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Delete what ``materialise`` wrote, once nothing reads it any more."""
    for df in frames:
        if path := getattr(df, "_linkforge_path", None):
            files, p = _files(df.sparkSession, path)
            files.delete(p, True)
