"""Sinks: managed / path tables, JDBC, keyed change logs, console.

The reference wrote to Hive (drop + save), MySQL (JDBC, partly from driver
arrays) and Redis (sets and hashes, some written after a driver collect).
Here every result stays a DataFrame until a writer that runs on executors:

- ``write_table``: replace a table (``saveAsTable``) or a path table,
  optionally partitioned (the visit log by ``date``, so a date bound prunes
  whole folders).
- ``write_jdbc``: Spark's JDBC writer (batched inserts per partition, one
  connection per task); needs a driver jar and a reachable database, neither
  exists in this repository's test setting, so it is not exercised here.
- the keyed sink of the streaming jobs (instead of Redis ``hset`` / ``hincrBy``
  / ``sadd``) is the landed log of ``streaming.ads_stream``.
- ``show_console``: ``show(n, truncate=False)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, target: str, partition_by: Sequence[str] | None = None,
                as_path: bool = True, fmt: str = "parquet") -> None:
    """Replace ``target`` with ``df`` (drop-then-save semantics).

    ``as_path=True``: ``target`` is a folder (e.g. in the shared checkpoint
    folder); else a catalog table name for ``saveAsTable``.
    """
    if partition_by:
        # rows of one partition value go to few tasks (AQE splits a hot value
        # and merges small ones), so each folder gets a few sized files rather
        # than one small file per task and value
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if as_path:
        w.save(target)
    else:
        w.saveAsTable(target)


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
               password: str | None = None, mode: str = "append", batch_size: int = 1000,
               num_partitions: int | None = None, driver: str | None = None) -> None:
    """Write ``df`` to a JDBC table (one connection per task, batched inserts).

    ``num_partitions`` caps the concurrent connections (coalesce before the
    write) so a large cluster does not open thousands of them.
    """
    out = df.coalesce(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batch_size))
    if user is not None:
        w = w.option("user", user)
    if password is not None:
        w = w.option("password", password)
    if driver is not None:
        w = w.option("driver", driver)
    w.save()


def show_console(df: DataFrame, n: int = 100) -> None:
    """Print up to ``n`` rows untruncated (a display sink, not a data path)."""
    df.show(n, truncate=False)
