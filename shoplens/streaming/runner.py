"""Run the streaming job over a replay, to completion (``availableNow``).

In production the query runs continuously on its trigger (5 s, as the
reference's micro-batches); for checks and the registered ``stream_*``
queries the same query runs with ``availableNow`` so it processes what is
there and stops.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from shoplens.sources.ads import landed_ads_lines
from shoplens.sources.line_log import RANGE_BYTES, Folder, read_line_stream
from shoplens.streaming import ads_stream as S
from shoplens.streaming import blacklist, sliding, totals
from shoplens.streaming.replay import read_replay, write_replay

AVAILABLE_NOW = {"availableNow": True}
QUERY_TIMEOUT_S = 3600
SPLIT_BYTES = 256 << 10  # least bytes of a file that a task reads (Spark's own 4 MiB is a whole window)
PACK_SPLIT_BYTES = 2 << 20  # the same where a task packs clicks: each starts a Python worker, for little work a click
LINE_QUERIES = 4  # that take the files of lines side by side; each keeps a Python process beside the driver
LINE_FILE_ROWS = 250_000  # lines of a file at most, so that there are files for all queries whatever read the table
# clicks of a micro-batch for which a replay has one more task per shuffle: on the JVM, with state by share (cells, pandas), by user
TABLE_ROWS, CELL_ROWS, SHARE_ROWS, STATE_ROWS = 25_000, 80_000, 10_000, 1_000


def _await(q) -> None:
    q.awaitTermination(QUERY_TIMEOUT_S)
    if q.exception() is not None:
        raise RuntimeError(f"streaming query {q.name or q.id} failed") from q.exception()
    if q.isActive:
        q.stop()
        raise TimeoutError(f"streaming query {q.id} did not finish in {QUERY_TIMEOUT_S} s")


def run_ads_pipeline(clicks: DataFrame, folder: str, batch_seconds: int, threshold: int,
                     keep_days: int | None = None,
                     state_partitions: int | None = None, stage1: str = "tables") -> str:
    """Replay ``clicks`` in windows of ``batch_seconds`` through the streaming
    job; returns the output folder (read it with ``ads_stream.read_*``).

    A stateful query fixes its number of state partitions at its first start
    (from ``spark.sql.shuffle.partitions``), and every micro-batch runs one
    task per state partition. The replay sets it to ``state_partitions``
    (default: the context's parallelism) for the queries it starts and then
    restores the session setting. ``stage1`` picks the blacklist stage:
    ``"tables"`` (JVM only, state in the landed tables) or ``"state"``
    (``applyInPandasWithState``).
    """
    spark = clicks.sparkSession
    windows = write_replay(clicks, os.path.join(folder, "replay"), batch_seconds)
    rows = TABLE_ROWS if stage1 == "tables" else SHARE_ROWS if keep_days is None else STATE_ROWS
    with state_tasks(spark, replay_tasks(spark, folder, windows, state_partitions, rows)):
        return _run(spark, folder, threshold, keep_days, stage1)


def replay_tasks(spark: SparkSession, folder: str, windows: int, least: int | None, rows_per_task: int) -> int:
    """Tasks per shuffle of a replay: one per ``rows_per_task`` clicks of its mean
    micro-batch (counted in the files' footers), at least ``least`` (default: the
    context's parallelism) and at most three per core, as each may be a state store."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.read.parquet(os.path.join(folder, "replay", "files")).count() if windows else 0
    return max(least or cores, min(-(-rows // max(1, windows * rows_per_task)), 3 * cores))


@contextmanager
def state_tasks(spark: SparkSession, n: int | None, split_bytes: int = SPLIT_BYTES) -> Iterator[None]:
    """``n`` state partitions (default: the context's parallelism) for the queries started
    inside, and reads of files small enough for a micro-batch to have several tasks."""
    new = {"spark.sql.shuffle.partitions": str(n or spark.sparkContext.defaultParallelism),
           "spark.sql.files.openCostInBytes": str(split_bytes)}
    old = {k: spark.conf.get(k) for k in new}
    try:
        for k, v in new.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _run(spark, folder, threshold, keep_days, stage1) -> str:
    out = os.path.join(folder, "out")
    ckpt = os.path.join(folder, "checkpoints")
    src = read_replay(spark, os.path.join(folder, "replay"))
    if stage1 == "tables":
        q = S.start_blacklist_tables(src, out, os.path.join(ckpt, "blacklist"), threshold,
                                     trigger=AVAILABLE_NOW)
    else:
        q = S.start_blacklist(src, out, os.path.join(ckpt, "blacklist"), threshold, keep_days,
                              trigger=AVAILABLE_NOW,
                              lateness=None if keep_days is None else "1 day")
    _await(q)
    return out


def run_lines(lines: DataFrame, folder: str, max_bytes: int) -> str:
    """Land ``value`` lines as files and take them through the offset-addressed
    source, ``max_bytes`` a micro-batch. The files are dealt to at most ``LINE_QUERIES``
    queries, each of which goes on from part to part until it finds nothing: a micro-batch
    is one small task, and its time is the driver's and the checkpoint's, so a single query
    leaves the cluster idle. Returns the folder of clicks (kind good) and bad lines with
    their reason (kind bad); read it with ``read_lines``."""
    spark = lines.sparkSession
    source, ckpt, out = (os.path.join(folder, x) for x in ("lines", "checkpoints", "clicks"))
    (lines.select("value").where("value is not null").write.mode("overwrite")
     .option("maxRecordsPerFile", LINE_FILE_ROWS).text(source))
    shares = dealt(Folder(source).sizes(), LINE_QUERIES)
    queries = []
    try:
        for i, files in enumerate(shares):
            tag, part = (f"-{i}", f"query={i}") if len(shares) > 1 else ("", "")
            value = read_line_stream(spark, source, "earliest", max_bytes, os.path.join(ckpt, f"positions{tag}.json"),
                                     RANGE_BYTES, files)
            queries.append(landed_ads_lines(value).writeStream.format("parquet").partitionBy("kind")
                           .option("path", os.path.join(out, part)).option("checkpointLocation", os.path.join(ckpt, f"lines{tag}"))
                           .trigger(processingTime="0 seconds").start())
        for q in queries:
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()
    return out


def dealt(sizes: dict[str, int], parts: int) -> list[list[str]]:
    """Files in at most ``parts`` lists of about equal bytes, at least one list."""
    full = sorted((f for f in sizes if sizes[f]), key=lambda f: (-sizes[f], f))
    lists: list[list[str]] = [[] for _ in range(max(1, min(parts, len(full))))]
    for f in full:
        min(lists, key=lambda x: sum(sizes[y] for y in x)).append(f)
    return lists


def read_lines(spark: SparkSession, out: str) -> DataFrame:
    """What ``run_lines`` landed, by the log of each of its queries."""
    p = spark._jvm.org.apache.hadoop.fs.Path(out)
    names = [x.getPath().getName() for x in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    folders = [os.path.join(out, n) for n in sorted(names) if n.startswith("query=")] or [out]
    return reduce(DataFrame.unionByName, [spark.read.parquet(f) for f in folders])


# --- the same over native state: folders ``blacklist``, ``totals``, ``sliding`` with ``out`` and ``checkpoint`` ---

def run_native_blacklist(clicks: DataFrame, folder: str, batch_seconds: int, threshold: int,
                         state_partitions: int | None = None, lateness: str | None = None) -> str:
    """Replay ``clicks`` through the blacklist with state by share of the users. The
    landed files stay ``state_partitions`` a micro-batch, however many tasks made them:
    the later queries take files by number, and a window cut between two of their
    micro-batches would make its second part late."""
    spark = clicks.sparkSession
    windows = write_replay(clicks, os.path.join(folder, "replay"), batch_seconds)
    with state_tasks(spark, replay_tasks(spark, folder, windows, state_partitions, CELL_ROWS), PACK_SPLIT_BYTES):
        _await(blacklist.start_blacklist_cells(
            read_replay(spark, os.path.join(folder, "replay")), os.path.join(folder, "blacklist", "out"),
            os.path.join(folder, "blacklist", "checkpoint"), threshold, lateness, trigger=AVAILABLE_NOW, files=state_partitions))
    return folder


def run_native_totals(spark: SparkSession, folder: str, lateness: str, files_per_trigger: int | None = None,
                      state_partitions: int | None = None) -> str:
    """Totals and top ads over the kept clicks that ``run_native_blacklist`` landed."""
    with state_tasks(spark, state_partitions):
        kept = blacklist.kept_stream(spark, os.path.join(folder, "blacklist", "out"), files_per_trigger)
        _await(totals.start_totals(kept, os.path.join(folder, "totals", "out"),
                                   os.path.join(folder, "totals", "checkpoint"), lateness, trigger=AVAILABLE_NOW))
    return folder


def run_native_sliding(spark: SparkSession, folder: str, slide: str, lateness: str,
                       files_per_trigger: int | None = None, state_partitions: int | None = None) -> str:
    """The sliding hour over the same kept clicks."""
    with state_tasks(spark, state_partitions):
        kept = blacklist.kept_stream(spark, os.path.join(folder, "blacklist", "out"), files_per_trigger)
        _await(sliding.start_sliding(kept, os.path.join(folder, "sliding", "out"),
                                     os.path.join(folder, "sliding", "checkpoint"), slide, lateness=lateness,
                                     parts=state_partitions or 8, trigger=AVAILABLE_NOW))
    return folder
