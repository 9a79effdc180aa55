"""Stored intermediates in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a local session gets a temporary folder, and a cluster an error: executors wouldn't see one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="fundpanel-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stage(df: DataFrame, by: str | None = None, parts: int | None = None, *more: DataFrame) -> DataFrame:
    """df written as a table and read again: what several branches read is computed once, and plans stay short.

    With a column and a number of parts that it is dealt into, it is stored in as many buckets: what groups, orders or joins by that column needs no exchange.
    More frames of the same columns are added to the buckets one after another, so that a task holds what one of them needs, where a union of frames that
    are dealt alike works on all of them in one task.
    Lazy results may read it as long as the session lives; the file system drops it when the driver ends.
    """
    name = f"stage_{uuid.uuid4().hex}"
    path = f"{shared_dir(df.sparkSession)}/{name}"
    out = df.write.option("compression", "zstd")
    if by and parts:
        out.bucketBy(parts, by).option("path", path).saveAsTable(name)
        for other in more:
            other.write.option("compression", "zstd").bucketBy(parts, by).option("path", path).mode("append").saveAsTable(name)
    else:
        out.parquet(path)
    where = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return df.sparkSession.table(name) if by and parts else df.sparkSession.read.schema(df.schema).parquet(path)
