"""Folders of micro-batches on whatever file system Spark writes to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def land_once(df: DataFrame, path: str) -> None:
    """Write a micro-batch by kind. One that is complete already (its query failed
    between the write and its own commit, and replays it) stays as it is, for a
    stream that reads these files would take rewritten ones for new; the rows are
    then only computed, so that the query's state comes to the same version."""
    if exists(df.sparkSession, f"{path}/_SUCCESS"):
        df.write.format("noop").mode("overwrite").save()
    else:
        df.write.mode("overwrite").partitionBy("kind").parquet(path)


def mark_once(spark: SparkSession, folder: str, name: str, value: str) -> None:
    """Note in a folder (of a checkpoint) what it was started with; refuse another value."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
    known = [x.split("=", 1)[1] for x in marks if x.startswith(f"{name}=")]
    if known and known != [value]:
        raise RuntimeError(f"{folder} was started with {name}={known[0]}, not {value}")
    fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{name}={value}"))
