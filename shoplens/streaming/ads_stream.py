"""Structured Streaming twins of the ad-click questions Q7-Q10.

One streaming query over the click stream; every output of a micro-batch is
landed in one write under ``log/batch_id=<id>/kind=<k>/day=<d>``, which a
replayed batch overwrites with the same rows, so the outputs are exactly once
with the query's checkpointed offsets.

Q7, the blacklist, in one of two forms:

- ``start_blacklist_tables`` (default): JVM only, ``foreachBatch`` over the
  micro-batch as a static DataFrame, the state in the landed tables.
- ``start_blacklist``: ``applyInPandasWithState``, whose calls cost milliseconds
  whatever they hold. By default it is grouped by one of ``shares`` hash parts of
  the users; the state of a share is a block of running counts per (user, ad) for
  each day, of which a micro-batch opens those it touches, and the blocked users.
  With ``lateness`` or ``keep_days``, and with ``shares=None``, it is grouped by
  user, as a timeout ends whole states: the running count per (ad, day) and a
  blocked flag. The rows of a share or user stream through one task in Arrow
  chunks (memory per key, not per row).

Kinds of rows: ``click`` (kept), ``block`` (user, day), and increments of one
batch: ``count`` per (user, ad, day), ``total`` per (day, area, city, ad) and
``minute`` per (minute, ad), which readers sum; ``newest`` (the batch's newest
click) and ``top`` (the top ads of the touched days, ranked again each batch).
Minute buckets keep the last hour at one row per (minute, ad): a 60-minute
window sliding every 10 s would copy each click 360 times.

What a batch must know of its past comes from snapshots: after every
``SNAPSHOT_EVERY`` batches the sums of the days touched since the last one (and
the whole blacklist) are written under ``snap/batch_id=<id>``. A batch then reads
by explicit path the newest snapshot of each day it touches and the few batches
since, never the log's root; the work of a batch does not grow with their
number. ``SNAPSHOT_EVERY`` changes the cost, never the result.

Late clicks: day and minute come from the click's own time, so a late click
adds to its own day and minute. Neither form has a lateness bound unless the
caller asks the state form for one (``lateness`` and ``keep_days``).
"""

from __future__ import annotations

import os
import sys
import warnings
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shoplens.functions import pairs_json
from shoplens.plans.ads import BLACKLIST_THRESHOLD, TOP_ADS
from shoplens.sources.ads import parse_ads_lines
from shoplens.streaming.blacklist import NULL_BIT, SHARE_OUT, SHARES, share_clicks, without_null_bits
from shoplens.streaming.landing import mark_once

STATE_SCHEMA = "keys array<string>, counts array<bigint>, blocked boolean, last_ms bigint"
OUT_SCHEMA = ("kind string, ts timestamp, area string, city string, user_id bigint, "
              "ads_id bigint, event_id bigint, day string, n bigint")
# the state of a share: each day's cells as rows of (user, ad, null bits, n), the blocked as (user, null bit)
SHARE_STATE_SCHEMA = "days array<string>, cells array<binary>, blocked binary"
SHARE_OUT_SCHEMA = OUT_SCHEMA.replace("ts timestamp", "us bigint") + ", nulls bigint"
CLICK_COLUMNS = ["ts", "area", "city", "user_id", "ads_id", "event_id", "day"]
DAY_MS = 86_400_000
SNAPSHOT_EVERY = 10
CLICK_FILES = 4
ROWS_PER_FILE = 100_000  # a day's rows of a kind are dealt over as many tasks and files as this asks for
# the steps go to the workers by value: they need no installation of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _blacklist_step(threshold: int, keep_days: int | None):
    """The per-user state function of stage 1."""

    def step(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # PySpark pads its output batches with empty pandas frames, which
        # pandas warns about on every concat; the warning is not ours.
        warnings.simplefilter("ignore", FutureWarning)
        if state.hasTimedOut:
            # an unblocked user idle for keep_days: its counters are all
            # older than any key a new click can touch, so the state goes
            state.remove()
            return
        if state.exists:
            keys, counts, blocked, last_ms = state.get
            totals = dict(zip(keys, counts))
        else:
            totals, blocked, last_ms = {}, False, 0
        # a user has few rows in a micro-batch: plain loops and columns added in
        # place, as every step of pandas costs more than the rows it takes
        batch: dict[str, int] = {}
        newest_day = None
        for pdf in chunks:
            if blocked:  # blocked before this batch: drop, do not count
                continue
            last_ms = max(last_ms, int(pdf["ts"].max().value // 1_000_000))
            for ad, day in zip(pdf["ads_id"].tolist(), pdf["day"].tolist()):
                kk = f"{ad}|{day}"
                batch[kk] = batch.get(kk, 0) + 1
                newest_day = day if newest_day is None or day > newest_day else newest_day
            pdf["kind"], pdf["n"] = "click", None
            yield pdf
        if not blocked and batch:
            blocked = any(totals.get(kk, 0) > threshold for kk in batch)
            # what this batch adds to user_ads_count_perday, and the block
            cells = [(int(ad), day, n) for (ad, day), n in ((kk.split("|", 1), n) for kk, n in batch.items())]
            rows = [*cells, (None, newest_day, None)] if blocked else cells
            ads, days, ns = (np.array(x, dtype=object) for x in zip(*rows))
            none = np.full(len(rows), None)
            yield pd.DataFrame({
                "kind": np.array(["count"] * len(cells) + ["block"] * blocked, dtype=object), "ts": pd.NaT, "area": none,
                "city": none, "user_id": int(key[0]), "ads_id": ads, "event_id": none, "day": days, "n": ns})
            for kk, n in batch.items():
                totals[kk] = totals.get(kk, 0) + n
            if newest_day is not None and keep_days is not None:
                cut = (pd.Timestamp(newest_day) - pd.Timedelta(days=keep_days)).strftime("%Y-%m-%d")
                totals = {kk: n for kk, n in totals.items() if kk.split("|", 1)[1] >= cut}
        # a blocked user keeps only the flag, for good (no timeout); with
        # keep_days, an unblocked one times out so long after its newest click
        if blocked:
            totals = {}
        state.update((list(totals.keys()), list(totals.values()), blocked, last_ms))
        if not blocked and keep_days is not None:
            state.setTimeoutTimestamp(last_ms + keep_days * DAY_MS)

    return step


def _block(rows: Iterable[tuple[int, ...]]) -> bytes:
    return np.array(list(rows), dtype=np.int64).tobytes()


def _unblock(block: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(block, dtype=np.int64).reshape(-1, columns)


def _share_step(threshold: int):
    """The per-share state function of stage 1. A user is (id, null bit) and a cell
    (id, ad, null bits), as in the clicks: pandas has no null integers."""
    of_user, of_cell = NULL_BIT["user_id"], NULL_BIT["user_id"] | NULL_BIT["ads_id"]

    def step(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        warnings.simplefilter("ignore", FutureWarning)  # as in _blacklist_step
        days, blocks, out = state.get if state.exists else ((), (), b"")
        cells = dict(zip(days, blocks))
        blocked = set(map(tuple, _unblock(out, 2).tolist()))
        batch: Counter = Counter()
        for pdf in chunks:
            if blocked:  # blocked before this batch: drop, do not count
                users = zip(pdf["user_id"].tolist(), (pdf["nulls"] & of_user).tolist())
                pdf = pdf[np.fromiter((u not in blocked for u in users), dtype=bool, count=len(pdf))]
            batch.update(zip(pdf["day"].tolist(), pdf["user_id"].tolist(), pdf["ads_id"].tolist(),
                             (pdf["nulls"] & of_cell).tolist()))
            yield pdf.assign(kind="click", n=0, nulls=pdf["nulls"] | NULL_BIT["n"])[SHARE_OUT]
        if not batch:
            return
        over, by_day = set(), {}
        for (day, *cell), n in batch.items():
            by_day.setdefault(day, []).append((*cell, n))
        for day, rows in by_day.items():
            known = {(user, ad, no): n for user, ad, no, n in _unblock(cells.get(day, b""), 4).tolist()}
            for user, ad, no, n in rows:
                before = known.get((user, ad, no), 0)
                if before > threshold:
                    over.add((user, no & of_user))
                known[user, ad, no] = before + n
            cells[day] = _block((*cell, n) for cell, n in known.items())
        # what this batch adds to user_ads_count_perday, and the blocks
        newest: dict[tuple[int, int], str | None] = {}
        for day, user, _, no in batch if over else ():
            if (who := (user, no & of_user)) in over and (who not in newest or (day or "") > (newest[who] or "")):
                newest[who] = day
        days, users, ads, nulls = map(list, zip(*batch, *((day, user, 0, no | NULL_BIT["ads_id"] | NULL_BIT["n"])
                                                          for (user, no), day in newest.items())))
        yield pd.DataFrame({
            "kind": ["count"] * len(batch) + ["block"] * len(newest), "us": 0, "area": None, "city": None, "user_id": users,
            "ads_id": ads, "event_id": 0, "day": days, "n": [*batch.values()] + [0] * len(newest),
            "nulls": np.array(nulls) | NULL_BIT["us"] | NULL_BIT["event_id"]})[SHARE_OUT]
        if over:  # a blocked user keeps only its place among the blocked, for good
            ids = np.array([user for user, no in over if not no], dtype=np.int64)
            for day in list(cells):
                c = _unblock(cells[day], 4)
                is_null = (c[:, 2] & of_user) > 0
                left = c[~np.where(is_null, (0, of_user) in over, np.isin(c[:, 0], ids))]
                if not len(left):
                    del cells[day]
                elif len(left) < len(c):
                    cells[day] = left.tobytes()
        state.update((list(cells.keys()), list(cells.values()), out + _block(over) if over else out))

    return step


def clicks_from_lines(lines: DataFrame, bad_dir: str | None = None,
                      checkpoint: str | None = None) -> tuple[DataFrame, StreamingQuery | None]:
    """Parse a stream of ad lines (Kafka ``value`` or text files).

    Returns the stream of good clicks (ts, area, city, user_id, ads_id, and a
    null event_id: lines carry none) and, if ``bad_dir`` is given, a started
    query that appends the bad lines with their reason there (a counted side
    output instead of a failed batch).
    """
    good, bad = parse_ads_lines(lines)
    q = None
    if bad_dir is not None:
        q = (bad.writeStream.format("parquet").option("path", bad_dir)
             .option("checkpointLocation", checkpoint or bad_dir + "_checkpoint")
             .outputMode("append").start())
    return good.withColumn("event_id", F.lit(None).cast("bigint")), q


def by_share(shares: int | None, keep_days: int | None, lateness: str | None) -> bool:
    """Whether the state lies by share of the users: forgetting ends the state of a user."""
    return shares is not None and keep_days is None and lateness is None


def blacklist_stream(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD,
                     keep_days: int | None = None, lateness: str | None = None,
                     shares: int | None = SHARES) -> DataFrame:
    """Stage-1 transformation: rows of kind 'click' (kept), 'block' and 'count'.

    By default nothing is dropped or forgotten. ``lateness`` sets a watermark:
    clicks older than it are dropped before the state. ``keep_days`` (which
    needs ``lateness`` and should exceed it) removes unblocked users idle that
    long, by an event-time timeout.
    """
    if keep_days is not None and lateness is None:
        raise ValueError("keep_days needs a lateness: its timeout follows the watermark")
    if by_share(shares, keep_days, lateness):
        c = clicks.select(F.unix_micros("ts").alias("us"), *CLICK_COLUMNS[1:-1], F.date_format("ts", "yyyy-MM-dd").alias("day"))
        out = share_clicks(c, shares, ["user_id", "ads_id", "event_id", "us"]).groupBy("share").applyInPandasWithState(
            _share_step(threshold), SHARE_OUT_SCHEMA, SHARE_STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
        return without_null_bits(out).select("kind", F.timestamp_micros("us").alias("ts"), *CLICK_COLUMNS[1:], "n")
    c = clicks if lateness is None else clicks.withWatermark("ts", lateness)
    c = c.select(*[x for x in CLICK_COLUMNS if x != "day"],
                 F.date_format("ts", "yyyy-MM-dd").alias("day"))
    timeout = GroupStateTimeout.NoTimeout if keep_days is None else GroupStateTimeout.EventTimeTimeout
    return c.groupBy("user_id").applyInPandasWithState(
        _blacklist_step(threshold, keep_days), OUT_SCHEMA, STATE_SCHEMA, "append", timeout)


# --- the landed output log --------------------------------------------------

LOG_FIELDS = [("ts", "timestamp"), ("area", "string"), ("city", "string"),
              ("user_id", "bigint"), ("ads_id", "bigint"), ("event_id", "bigint"),
              ("n", "bigint"), ("clicks", "bigint"), ("minute_start", "timestamp"),
              ("newest", "timestamp"), ("rank", "int")]
ROW_SCHEMA = ", ".join(f"{n} {t}" for n, t in LOG_FIELDS)
LOG_SCHEMA = ROW_SCHEMA + ", batch_id bigint, kind string, day string"
TOTAL_KEYS = ["day", "area", "city", "ads_id"]
COUNT_KEYS = ["user_id", "ads_id", "day"]
ALL_DAYS = "all"  # the folder of a snapshot's whole blacklist


def _rows(kind: str, source: str, **given: str) -> str:
    """SELECT of one kind in the log's column layout; ``given`` names the
    expressions of the columns it has (``day`` among them), the others are null."""
    cols = [f"CAST({given.get(n, 'NULL')} AS {t}) AS {n}" for n, t in LOG_FIELDS]
    return f"SELECT {', '.join(cols)}, '{kind}' AS kind, {given['day']} AS day FROM {source}"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, by Spark's own file system; none if it is absent."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []


def _value(name: str) -> str:
    return name.split("=", 1)[1]


def _sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """``query`` over views of the frames (view ``_name``). One statement is
    analysed once, where dozens of DataFrame calls are analysed one by one. The
    views stay until the next batch replaces them: dropping a view would drop
    the cached data behind it."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"_{name}")
    return spark.sql(query)


class Landing:
    """The landed log and snapshots of one streaming query, and which folders a
    batch reads. The index of folders is kept on the driver (a few names per
    day and batch since the last snapshot) and is rebuilt by listing when the
    query starts or replays a batch."""

    def __init__(self, spark: SparkSession, out_dir: str, every: int = SNAPSHOT_EVERY,
                 rows_per_file: int = ROWS_PER_FILE):
        self.out_dir, self.every, self.rows_per_file = out_dir, every, rows_per_file
        self.next: int | None = None
        self.snap: dict[tuple[str, str], int] = {}        # (kind, day) -> newest snapshot
        self.since: list[tuple[int, set[tuple[str, str]]]] = []  # batches after it, their folders

    def _folders(self, spark: SparkSession, path: str) -> set[tuple[str, str]]:
        return {(_value(k), _value(d)) for k in _children(spark, path) if k.startswith("kind=")
                for d in _children(spark, os.path.join(path, k)) if d.startswith("day=")}

    def locate(self, spark: SparkSession, batch_id: int) -> None:
        """Make the index describe the batches before ``batch_id``."""
        if self.next == batch_id:
            return
        self.snap, self.since = {}, []
        done = sorted(int(_value(x)) for x in _children(spark, os.path.join(self.out_dir, "snap"))
                      if x.startswith("batch_id="))
        done = [s for s in done if s < batch_id]
        for s in done:
            for key in self._folders(spark, os.path.join(self.out_dir, "snap", f"batch_id={s}")):
                self.snap[key] = s
        for b in range(max(done, default=-1) + 1, batch_id):
            self.since.append((b, self._folders(spark, os.path.join(self.out_dir, "log", f"batch_id={b}"))))
        self.next = batch_id

    def before(self, spark: SparkSession, kind: str, days: list[str] | None) -> DataFrame:
        """Rows of a kind before the next batch: the newest snapshot of each day
        and the increments since; ``days`` None: the blacklist. With ``day``."""
        paths = []
        for (k, d), s in self.snap.items():
            if k == kind and (d == ALL_DAYS if days is None else d in days):
                paths.append(f"snap/batch_id={s}/kind={k}/day={d}")
        for b, folders in self.since:
            paths += [f"log/batch_id={b}/kind={k}/day={d}" for k, d in sorted(folders)
                      if k == kind and (days is None or d in days)]
        if not paths:
            return spark.createDataFrame([], ROW_SCHEMA + ", day string")
        rows = spark.read.schema(ROW_SCHEMA).parquet(*[os.path.join(self.out_dir, p) for p in paths])
        return rows.withColumn("day", F.regexp_extract(F.input_file_name(), "/day=([^/]+)/[^/]*$", 1))

    def parts(self, rows: int) -> int:
        return max(1, -(-rows // self.rows_per_file))

    def land(self, spark: SparkSession, out: DataFrame, batch_id: int, clicks: int) -> None:
        """One write, in as many tasks and files of a kind and day as the batch's clicks
        (which no aggregated kind has more rows than) ask for, without relying on AQE:
        clicks stay in the tasks that hold them, other rows are dealt by their key."""
        is_click = F.col("kind") == "click"
        kept = out.where(is_click).coalesce(max(CLICK_FILES, self.parts(clicks)))
        salt = F.when(F.col("kind").isin("count", "total", "minute", "block"), self.dealt(clicks)).otherwise(0)
        rest = out.where(~is_click).repartition("kind", "day", salt)
        path = os.path.join(self.out_dir, "log", f"batch_id={batch_id}")
        kept.union(rest).write.mode("overwrite").partitionBy("kind", "day").parquet(path)
        self.since.append((batch_id, self._folders(spark, path)))
        self.next = batch_id + 1
        if self.next % self.every == 0:
            self._snapshot(spark, batch_id)

    def dealt(self, rows: int) -> Column:
        """The part of an aggregated row by its key."""
        return F.pmod(F.xxhash64("user_id", "ads_id", "area", "city", "minute_start"), F.lit(self.parts(rows)))

    def _snapshot(self, spark: SparkSession, batch_id: int) -> None:
        """Sums of the days touched since the last snapshot, and the blacklist."""
        touched = sorted({d for _, folders in self.since for k, d in folders if k == "total"})
        path = os.path.join(self.out_dir, "snap", f"batch_id={batch_id}")
        out = _sql(spark, " UNION ALL ".join([
            _rows("block", "(SELECT DISTINCT user_id FROM _blocks)", user_id="user_id", day=f"'{ALL_DAYS}'"),
            _rows("count", "(SELECT user_id, ads_id, day, sum(n) AS n FROM _counts GROUP BY ALL)",
                  **_same(*COUNT_KEYS, "n")),
            _rows("total", "(SELECT day, area, city, ads_id, sum(clicks) AS clicks FROM _totals GROUP BY ALL)",
                  **_same(*TOTAL_KEYS, "clicks"))]),
            blocks=self.before(spark, "block", None), counts=self.before(spark, "count", touched),
            totals=self.before(spark, "total", touched))
        # rows before they are summed, from the files' footers: no kind and day has more
        rows = spark.sql("SELECT (SELECT count(*) FROM _blocks) + (SELECT count(*) FROM _counts) "
                         "+ (SELECT count(*) FROM _totals)").first()[0]
        out.repartition("kind", "day", self.dealt(rows)).write.mode("overwrite").partitionBy("kind", "day").parquet(path)
        for key in self._folders(spark, path):
            self.snap[key] = batch_id
        self.since = []


def _log(spark: SparkSession, out_dir: str, kind: str, days: list[str] | None = None) -> DataFrame:
    """One kind of the whole landed log (for readers of results)."""
    log = spark.read.schema(LOG_SCHEMA).parquet(os.path.join(out_dir, "log"))
    cond = F.col("kind") == kind
    return log.where(cond if days is None else cond & F.col("day").isin(days))


def _guard_start(spark: SparkSession, out_dir: str, checkpoint: str) -> None:
    """Refuse a checkpoint and a log that do not belong together. The state
    (blacklist, counts) lives in the log and the position in the checkpoint:
    a checkpoint without its log would unblock every user, a log without its
    checkpoint would be overwritten from batch 0 on."""
    progress = _children(spark, os.path.join(checkpoint, "offsets"))
    landed = [x for x in _children(spark, os.path.join(out_dir, "log"))
              if x.startswith("batch_id=") and int(_value(x)) >= 0]
    if progress and not _children(spark, os.path.join(out_dir, "log")):
        raise RuntimeError(f"checkpoint {checkpoint} has progress but {out_dir}/log is missing; "
                           "use a new checkpoint or restore the log")
    if landed and not progress:
        raise RuntimeError(f"{out_dir}/log holds landed batches but checkpoint {checkpoint} has no "
                           "progress; use the log's own checkpoint or another output folder")


def _seed(spark: SparkSession, out_dir: str) -> None:
    """An empty batch -1 so readers find the log before the first batch."""
    (spark.createDataFrame([], ROW_SCHEMA).write
     .mode("overwrite").parquet(os.path.join(out_dir, "log", "batch_id=-1", "kind=seed",
                                             "day=1970-01-01")))


def _no_aqe(spark: SparkSession) -> None:
    """For the sink's own session: a micro-batch is one job per action instead
    of one per shuffle. Nothing in it needs runtime splitting: rows are
    aggregated before they are dealt by user, area or minute."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")


# a kept click with what it counts for; every kind aggregates these before its own shuffle
CELLS = """
SELECT user_id, ads_id, day, area, city, date_trunc('minute', ts) AS minute_start, 1L AS c, ts AS newest
FROM _kept"""

# (user, ad, day) of one micro-batch, with the counts before it and its own
KEYS = """
SELECT user_id, ads_id, day, sum(before) AS before, sum(now) AS now
FROM (SELECT user_id, ads_id, day, n AS before, 0L AS now FROM _counts
      UNION ALL SELECT user_id, ads_id, day, 0L, c FROM _cells) GROUP BY ALL HAVING sum(now) > 0"""

# Q8-Q10 rows of one micro-batch, from its cells and the totals before it of
# the days it touches (``earlier``)
AD_STATS = [
    _rows("total", "(SELECT day, area, city, ads_id, sum(c) AS clicks FROM _cells GROUP BY ALL)",
          **_same(*TOTAL_KEYS, "clicks")),
    _rows("minute", """(SELECT day, minute_start, ads_id, sum(c) AS clicks, max(newest) AS newest
                        FROM _cells GROUP BY ALL)""",
          **_same("day", "minute_start", "ads_id", "clicks", "newest")),
    _rows("top", f"""(
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY day, area ORDER BY clicks DESC, ads_id) AS rank
          FROM (SELECT day, area, ads_id, sum(clicks) AS clicks
                FROM (SELECT day, area, ads_id, clicks FROM _earlier
                      UNION ALL SELECT day, area, ads_id, c FROM _cells) GROUP BY ALL))
        WHERE rank <= {TOP_ADS})""", **_same("day", "area", "ads_id", "clicks", "rank")),
]


def _span(cells: DataFrame) -> tuple[list[str], str | None, int]:
    """The days a micro-batch touches (its own time span plus late clicks'
    days), a VALUES list with its newest click, and its number of kept clicks."""
    rows = cells.groupBy("day").agg(F.unix_micros(F.max("newest")).alias("us"), F.sum("c").alias("clicks")).collect()
    clicks = sum(r["clicks"] for r in rows)
    days = {r["day"]: r["us"] for r in rows if r["day"] is not None}
    if not days:
        return [], None, clicks
    us = max(days.values())
    return sorted(days), f"(SELECT timestamp_micros({us}) AS newest)", clicks


def _newest(values: str | None) -> list[str]:
    return [] if values is None else [
        _rows("newest", values, newest="newest", day="date_format(newest, 'yyyy-MM-dd')")]


def start_blacklist(clicks: DataFrame, out_dir: str, checkpoint: str,
                    threshold: int = BLACKLIST_THRESHOLD, keep_days: int | None = None,
                    trigger: dict | None = None, lateness: str | None = None,
                    snapshot_every: int = SNAPSHOT_EVERY, shares: int | None = SHARES) -> StreamingQuery:
    """The streaming job with Spark-managed state (``applyInPandasWithState``).

    Lands kept clicks, newly blocked users, the batch's counts per (user, ad,
    day), and the Q8-Q10 rows in one write per micro-batch. The number of shares
    belongs to the checkpoint; another one is refused.
    """
    spark = clicks.sparkSession
    _guard_start(spark, out_dir, checkpoint)
    if by_share(shares, keep_days, lateness):
        mark_once(spark, checkpoint, "shares", str(shares))
    _seed(spark, out_dir)
    landing = Landing(spark, out_dir, snapshot_every)

    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        _no_aqe(spark)
        landing.locate(spark, batch_id)
        df = df.persist()
        cells = _sql(spark, CELLS, kept=df.where(F.col("kind") == "click"))
        days, newest, clicks = _span(cells)
        landing.land(spark, _sql(spark, " UNION ALL ".join([
            _rows("click", "_out WHERE kind = 'click'", **_same(*CLICK_COLUMNS)),
            _rows("block", "_out WHERE kind = 'block'", **_same("user_id", "day")),
            _rows("count", "_out WHERE kind = 'count'", **_same(*COUNT_KEYS, "n")),
            *AD_STATS, *_newest(newest)]),
            out=df, cells=cells, earlier=landing.before(spark, "total", days)), batch_id, clicks)
        df.unpersist()

    w = (blacklist_stream(clicks, threshold, keep_days, lateness, shares).writeStream
         .outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def start_blacklist_tables(clicks: DataFrame, out_dir: str, checkpoint: str,
                           threshold: int = BLACKLIST_THRESHOLD, trigger: dict | None = None,
                           snapshot_every: int = SNAPSHOT_EVERY,
                           rows_per_file: int = ROWS_PER_FILE) -> StreamingQuery:
    """The streaming job on the JVM only, with its state in the landed log.

    Each micro-batch b is a static DataFrame in ``foreachBatch``:

    1. the users blocked before b are the newest blacklist snapshot and the
       blocks since (a broadcast when the file statistics are under the
       threshold, else a shuffle join); the batch's clicks of others are kept;
    2. every count of kept clicks is aggregated before its shuffle, so a user
       holding a third of the batch is few rows per task; clicks are not shuffled;
    3. the counts before b of the touched days and the batch's own are summed
       side by side per (user, ad, day): a key of this batch whose count before
       it exceeds the threshold blocks its user;
    4. kept clicks, blocks, increments and the Q8-Q10 rows land in one write.

    Reads see batches < b only and the write overwrites batch b, so a replayed
    batch reproduces the same output. No Python runs per row.
    """
    spark = clicks.sparkSession
    _guard_start(spark, out_dir, checkpoint)
    _seed(spark, out_dir)
    landing = Landing(spark, out_dir, snapshot_every, rows_per_file)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _no_aqe(spark)
        landing.locate(spark, batch_id)
        c = batch.select(*[x for x in CLICK_COLUMNS if x != "day"],
                         F.date_format("ts", "yyyy-MM-dd").alias("day"))
        blocked = landing.before(spark, "block", None).select("user_id").distinct()
        kept = c.join(blocked, "user_id", "left_anti").persist()
        cells = _sql(spark, CELLS, kept=kept)
        days, newest, clicks = _span(cells)
        # blocks and counts both come from these: kept, or the counts before are read and shuffled for each
        keys = _sql(spark, KEYS, counts=landing.before(spark, "count", days), cells=cells).persist()
        landing.land(spark, _sql(spark, " UNION ALL ".join([
            _rows("click", "_kept", **_same(*CLICK_COLUMNS)),
            _rows("block", f"""(SELECT user_id, CAST(max(CAST(day AS date)) AS string) AS day FROM _keys
                                GROUP BY user_id HAVING max(before) > {int(threshold)})""",
                  **_same("user_id", "day")),
            _rows("count", "_keys", user_id="user_id", ads_id="ads_id", day="day", n="now"),
            *AD_STATS, *_newest(newest)]),
            kept=kept, cells=cells, keys=keys, earlier=landing.before(spark, "total", days)), batch_id, clicks)
        keys.unpersist()
        kept.unpersist()

    w = (clicks.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(sink))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


# --- readers of the landed log ------------------------------------------------

def read_kept(spark: SparkSession, out_dir: str) -> DataFrame:
    return _log(spark, out_dir, "click").select(*CLICK_COLUMNS, "batch_id")


def read_blocked(spark: SparkSession, out_dir: str) -> DataFrame:
    """The blacklist: user_id, blocked_day (first block wins)."""
    b = _log(spark, out_dir, "block")
    return b.groupBy("user_id").agg(F.min_by("day", "batch_id").alias("blocked_day"))


def read_user_ad_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """user_id, ads_id, day, n: kept clicks per user, ad and day so far."""
    return _log(spark, out_dir, "count").groupBy(*COUNT_KEYS).agg(F.sum("n").alias("n"))


def read_daily_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """day, area, city, ads_id, clicks: the sum of the landed increments."""
    return (_log(spark, out_dir, "total").groupBy(*TOTAL_KEYS)
            .agg(F.sum("clicks").alias("clicks")))


def read_area_top(spark: SparkSession, out_dir: str) -> DataFrame:
    """day, area, ads_id, clicks, rank from the newest ranking of each pair."""
    t = _log(spark, out_dir, "top")
    newest = t.groupBy("day", "area").agg(F.max("batch_id").alias("batch_id"))
    return t.join(newest, ["day", "area", "batch_id"]).select("day", "area", "ads_id", "clicks",
                                                               "rank")


def read_area_top_json(spark: SparkSession, out_dir: str) -> DataFrame:
    top = read_area_top(spark, out_dir)
    g = top.groupBy("day", "area").agg(F.sort_array(F.collect_list(F.struct(
        "rank", F.col("ads_id").alias("k"), F.col("clicks").alias("v")))).alias("_l"))
    return g.select("day", "area", pairs_json("_l").alias("top_ads"))


def read_last_hour(spark: SparkSession, out_dir: str, minutes: int = 60) -> DataFrame:
    """ads_id, minute (HH:mm), clicks, minute_start: the clicks of each minute in
    the last ``minutes`` before the newest click, cut at the raw click.

    The newest click comes from the one-row-per-batch ``newest`` rows. Whole
    minutes are sums of the minute increments; only the oldest minute, which
    the hour cuts, is counted from its kept clicks. Both are read only in the
    day folders the hour spans."""
    newest = _log(spark, out_dir, "newest").select(F.max("newest")).scalar()
    since = newest - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    span = F.col("day").between(F.date_format(since, "yyyy-MM-dd"), F.date_format(newest, "yyyy-MM-dd"))
    whole = (_log(spark, out_dir, "minute").where(span & (F.col("minute_start") > since))
             .select("minute_start", "ads_id", "clicks"))
    cut = (_log(spark, out_dir, "click").where(span & (F.col("ts") > since))
           .select(F.date_trunc("minute", "ts").alias("minute_start"), "ads_id",
                   F.lit(1).cast("bigint").alias("clicks"))
           .where(F.col("minute_start") <= since))
    cur = whole.unionByName(cut).groupBy("minute_start", "ads_id").agg(F.sum("clicks").alias("clicks"))
    return cur.select("ads_id", F.date_format("minute_start", "HH:mm").alias("minute"), "clicks",
                      "minute_start")


def read_last_hour_json(spark: SparkSession, out_dir: str, minutes: int = 60) -> DataFrame:
    last = read_last_hour(spark, out_dir, minutes)
    g = last.groupBy("ads_id").agg(F.sort_array(F.collect_list(F.struct(
        "minute_start", F.col("minute").alias("k"), F.col("clicks").alias("v")))).alias("_l"))
    return g.select("ads_id", pairs_json("_l").alias("minutes"))
