"""Tables of intermediate results in the folder that the driver and all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under ``spark.checkpoint.dir``.

    Without that setting, Spark on this machine alone gets a temporary folder; a cluster without it is an error.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in a new :func:`folder` and read back: it is computed once, and lineage ends here."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def deleted(spark: SparkSession, *paths: str) -> None:
    """Folders that nothing will read any more are deleted."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freed(spark: SparkSession, *tables: DataFrame) -> None:
    """:func:`stored` ``tables`` that nothing will read any more are deleted; shuffles of earlier steps that nothing refers to may be cleaned
    from the executors' disks."""
    deleted(spark, *(t.stored_path for t in tables))
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def tasks_for(spark: SparkSession, rows: int, each: int = 500_000) -> int:
    """Tasks that a shuffle of ``rows`` is dealt to: as many as the session's setting, more if a task had more than ``each``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))
