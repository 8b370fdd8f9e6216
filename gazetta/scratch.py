"""Scratch tables in the folder that the session names in ``spark.checkpoint.dir``.

Every executor can reach that folder, so a table written there survives the loss of any executor and cuts the lineage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with scheme and authority, as Spark's file systems resolve it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + found[5:] if found.startswith("file:/") and not found.startswith("file://") else found


def scratch_root(spark: SparkSession) -> str:
    """The session's part of the shared folder ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; a cluster has no
    folder that all executors share unless one is named, so there it is an error.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="gazetta-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{qualified(spark, top).rstrip('/')}/gazetta-{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the session's part of the shared folder."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables and files of this application; frames built on them can't be read afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to a shared scratch table and return a scan of it."""
    path = scratch_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A small input dealt out to all cores before work that is long for its size (parsing in Python workers).

    By Spark's estimate of its size, an input that fills a partition a core is left as it is: nothing is shuffled at scale. Streams are left as they are.
    """
    spark = df.sparkSession
    if df.isStreaming:
        return df
    size, cores = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())), spark.sparkContext.defaultParallelism
    full = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if size < cores * full else df
