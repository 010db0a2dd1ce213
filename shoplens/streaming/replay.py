"""Replay of stored clicks as a file stream with fixed micro-batch boundaries.

The Kafka topic of the reference cannot be run here; its replayable twin is
a folder of parquet files read with ``maxFilesPerTrigger``. The file source
takes files in modification-time order, so all windows are written by one job,
one file each, and the files' times are then set in window order (file system
calls, no Spark job). The whole of a window is one file by design, as the
source counts files; its row groups are small, so that several tasks read it. This
is a test and check tool, not an ingestion path.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.sources.ads import read_ads_file_stream

ROW_GROUP_BYTES = 1 << 20  # of a window's file, before compression
REPLAY_COLUMNS = ["ts_ms", "area", "city", "user_id", "ads_id", "event_id"]


def write_replay(clicks: DataFrame, folder: str, batch_seconds: int) -> int:
    """Write click rows (ts, area, city, user_id, ads_id, event_id) so that a
    file stream with ``maxFilesPerTrigger=1`` sees exactly one
    ``batch_seconds`` window per micro-batch (one file per window: a window
    split into several files could land fewer files than asked when small,
    and the next window's file would join its micro-batch). Returns the
    number of windows."""
    spark = clicks.sparkSession
    files = os.path.join(folder, "files")
    ms = F.unix_millis("ts")
    (clicks.select(ms.alias("ts_ms"), "area", "city", "user_id", "ads_id", "event_id",
                   F.floor(ms / F.lit(batch_seconds * 1000)).alias("window"))
     .repartition("window").sortWithinPartitions("window")
     .write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("window").parquet(files))
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(files).getFileSystem(spark._jsc.hadoopConfiguration())
    windows = sorted(int(x.getPath().getName().split("=")[1]) for x in fs.listStatus(path(files))
                     if x.getPath().getName().startswith("window="))
    for i, w in enumerate(windows):
        inside = [x.getPath() for x in fs.listStatus(path(os.path.join(files, f"window={w}")))]
        data = [x for x in inside if x.getName().endswith(".parquet")]
        if len(data) != 1:
            raise RuntimeError(f"window {w} has {len(data)} files; a replay needs one each")
        fs.setTimes(data[0], 1_000_000_000_000 + i * 1000, -1)
    return len(windows)


def read_replay(spark, folder: str) -> DataFrame:
    """The replay folder as a stream of clicks (``ts`` TIMESTAMP), one window
    per micro-batch."""
    return read_ads_file_stream(spark, os.path.join(folder, "files", "*"), 1).select(
        "ts", "area", "city", "user_id", "ads_id", "event_id")
