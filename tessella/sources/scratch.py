"""Tables that a job writes for itself in the cluster's shared folder."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new path in the shared folder; a default of one machine only where Spark runs on one (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "/tmp/checkpoints/tessella"
    return f"{found.rstrip('/')}/tessella-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """Write and reread ``df``, so that values drawn once stay the same in every later use."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go now, which Spark removes once the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone at exit; the folder is scratch space
        pass
