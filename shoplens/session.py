"""Spark session settings and the shared folder for lineage cuts and sinks."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Day / minute labels follow the session time
# zone, so it is fixed to UTC (the reference used the JVM default zone).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # state on disk; processors with more than one state variable or timers need it
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_spark(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "shoplens", extra: dict | None = None) -> SparkSession:
    """A session for tests and the bench; on a cluster use the cluster's own."""
    if not master.startswith("local"):
        raise ValueError("build_spark is for local runs; on a cluster use the cluster's session")
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shoplens-ckpt-"))
         .config("spark.python.unix.domain.socket.enabled", "true"))  # state calls of Python without a port
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs need to a session someone else built."""
    for k, v in SESSION_CONF.items():  # all of them can be set at run time
        spark.conf.set(k, v)
    return spark


_LOCAL_SHARED: dict[int, str] = {}


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, taken from ``spark.checkpoint.dir``.

    On a cluster this setting names the shared checkpoint folder and is used
    as is. Only when it is unset and the master is one local process (tests)
    is a scratch folder made; elsewhere an unset folder is an error, as each
    executor would write to its own disk.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        key = id(sc)
        if key not in _LOCAL_SHARED:
            _LOCAL_SHARED[key] = tempfile.mkdtemp(prefix="shoplens-ckpt-")
        base = _LOCAL_SHARED[key]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return os.path.join(base, *parts) if parts else base
