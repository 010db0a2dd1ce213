"""The dynamic blacklist (Q7) as a stateful processor: one counter per (day, ad) of a user.

The rule is the closed form of ``plans.ads``: at a micro-batch, a cell (user, day,
ad) it touches whose count before it is over the threshold blocks the user for
good; the clicks of that batch are kept. The state has one of two layouts:

- by share (default): ``transformWithStateInPandas`` keyed by one of ``shares``
  hash parts of the users, with a map from day to the share's cells of that day and
  one value with its blocked users. A micro-batch makes two state calls per share
  and day it touches, whatever the number of users and cells. The clicks come to it
  in blocks, one per share and task that read them (``packed``): a row costs Spark
  more than all that is done for a click;
- by user (``shares=None``, and with ``ttl``): ``transformWithState`` keyed by user,
  with a map cell per (day, ad), of which a micro-batch reads and writes those it
  touches, and the day of the block. Every cell costs two calls of some tenths of a
  millisecond.

What is forgotten is the caller's choice:

- nothing (default);
- ``lateness``: a timer per open day gives up that day's cells when the
  watermark (the newest click less the lateness) passes the end of the day. A
  click that comes later than that goes to the side output ``late``, uncounted;
- ``ttl``: cells expire so long after their last change by the clock, without a
  watermark.

A blocked user's flag never expires. Output rows: ``click`` (kept), ``block``,
``count`` (the new running count of a touched cell) and ``late``, landed by one
write per micro-batch, once. The rows of a user or share stream through one task,
one by one or in chunks of some thousands; memory is bounded by the cells of a share's
touched days, not by its rows. The number of shares belongs to the checkpoint, as
the number of state partitions does; another one is refused.
"""

from __future__ import annotations

import os
import sys
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from shoplens.plans.ads import BLACKLIST_THRESHOLD
from shoplens.session import prepare
from shoplens.streaming.landing import land_once, mark_once
from shoplens.streaming.totals import seconds

CLICK = ["ts", "area", "city", "user_id", "ads_id", "event_id", "day"]
OUT = Row("kind", "us", "area", "city", "user_id", "ads_id", "event_id", "day", "n")
OUT_SCHEMA = ("kind string, us bigint, area string, city string, user_id bigint, ads_id bigint, "
              "event_id bigint, day string, n bigint")
LOG_SCHEMA = OUT_SCHEMA.replace("us bigint", "ts timestamp") + ", batch_id bigint"
DAY_MS = 86_400_000
SHARES = 128  # parts of the users; each is a state key
PACK_ROWS = 100_000  # clicks of a task that are dealt into blocks at once
CHUNK_ROWS = 10_000  # clicks of a share that are worked on at once, but for one block
# pandas has no null integers: between Spark and the shares a null is 0 and its bit set
NULL_BIT = {"user_id": 1, "ads_id": 2, "event_id": 4, "us": 8, "n": 16}
SHARE_OUT = [*OUT_SCHEMA.replace(" bigint", "").replace(" string", "").split(", "), "nulls"]
# the processor goes to the workers by value: they need no installation of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def day_end(day: str) -> int:
    """The end of a day in epoch milliseconds (UTC)."""
    return int(datetime.fromisoformat(day).replace(tzinfo=UTC).timestamp()) * 1000 + DAY_MS


class Blacklist(StatefulProcessor):
    """The state of one user; ``timed``: cells of a day end with a timer."""

    def __init__(self, threshold: int, timed: bool, ttl_ms: int | None):
        self.threshold, self.timed, self.ttl_ms = threshold, timed, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.cells = handle.getMapState("cells", "day string, ads_id bigint", "n bigint", ttlDurationMs=self.ttl_ms)
        self.blocked = handle.getValueState("blocked", "day string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.blocked.get() is not None:
            for _ in rows:  # blocked before this batch: dropped, not counted
                pass
            return
        watermark = timerValues.getCurrentWatermarkInMs() if self.timed else None
        touched: dict[tuple, int] = {}
        ends: dict[str, int] = {}
        for r in rows:
            if r.day not in ends:
                ends[r.day] = day_end(r.day)
            late = self.timed and ends[r.day] <= watermark
            yield OUT("late" if late else "click", r.us, r.area, r.city, r.user_id, r.ads_id, r.event_id, r.day, None)
            if not late:
                touched[r.day, r.ads_id] = touched.get((r.day, r.ads_id), 0) + 1
        over, days = False, {day for day, _ in touched}
        for cell, n in touched.items():
            known = self.cells.getValue(cell)
            before = known[0] if known else 0
            over = over or before > self.threshold
            self.cells.updateValue(cell, (before + n,))
            yield OUT("count", None, None, None, key[0], cell[1], None, cell[0], before + n)
        if self.timed:
            for day in days:
                self.handle.registerTimer(ends[day])
        if over:
            self.blocked.update((max(days),))
            yield OUT("block", None, None, None, key[0], None, None, max(days), None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = expiredTimerInfo.getExpiryTimeInMs()
        for cell in list(self.cells.keys()):
            if day_end(cell[0]) <= until:
                self.cells.removeKey(cell)
        return iter(())

    def close(self) -> None:
        pass


def _with_nulls(pdf: pd.DataFrame, name: str) -> list:
    values, missing = pdf[name].tolist(), (pdf["nulls"].to_numpy() & NULL_BIT[name]) > 0
    return [None if no else v for v, no in zip(values, missing.tolist())] if missing.any() else values


def _longs(values: Iterable[int | None]) -> array | list:
    """A value of a state array: as one block where no value is null, for Spark looks at each item of a list."""
    values = list(values)
    return values if None in values else array("l", values)


class BlacklistShare(StatefulProcessor):
    """The state of a share of the users; ``timed``: cells of a day end with a timer."""

    def __init__(self, threshold: int, timed: bool):
        self.threshold, self.timed = threshold, timed

    def init(self, handle) -> None:
        self.handle = handle
        self.cells = handle.getMapState("cells", "day string", "users array<bigint>, ads array<bigint>, counts array<bigint>")
        self.blocked = handle.getValueState("blocked", "users array<bigint>, days array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        blocked = dict(zip(*(self.blocked.get() or ((), ()))))
        watermark = timerValues.getCurrentWatermarkInMs() if self.timed else None
        ends: dict[str, int] = {}
        touched: Counter = Counter()
        for pdf in rows:
            users = _with_nulls(pdf, "user_id")
            if blocked:  # blocked before this batch: dropped, not counted
                fresh = [u not in blocked for u in users]
                if not all(fresh):
                    pdf, users = pdf[np.array(fresh)], list(compress(users, fresh))
            if not users:
                continue
            days = pdf["day"].tolist()
            ends |= {day: day_end(day) for day in set(days) - ends.keys()}
            gone = {day for day, end in ends.items() if self.timed and end <= watermark}
            kinds = ["late" if day in gone else "click" for day in days] if gone else "click"
            yield pdf.assign(kind=kinds, n=0, nulls=pdf["nulls"] | NULL_BIT["n"])[SHARE_OUT]
            cells = zip(days, users, _with_nulls(pdf, "ads_id"))
            touched.update((c for c in cells if c[0] not in gone) if gone else cells)
        if not touched:
            return
        over, known, counts = set(), {}, []
        for (day, user, ad), n in touched.items():
            if day not in known:
                users, ads, before = self.cells.getValue((day,)) or ((), (), ())
                known[day] = dict(zip(zip(users, ads), before))
            before = known[day].get((user, ad), 0)
            if before > self.threshold:
                over.add(user)
            known[day][user, ad] = before + n
            counts.append(before + n)
        for day, cells in known.items():
            users, ads = zip(*cells)
            self.cells.updateValue((day,), (_longs(users), _longs(ads), _longs(cells.values())))
            if self.timed:
                self.handle.registerTimer(ends[day])
        days, users, ads = map(list, zip(*touched))
        newest: dict[int | None, str] = {}
        if over:
            for day, user in zip(days, users):
                if user in over:
                    newest[user] = max(day, newest.get(user, day))
            blocked |= newest
            self.blocked.update((_longs(blocked), list(blocked.values())))
        no = [None] * len(newest)
        yield self._frame(["count"] * len(counts) + ["block"] * len(newest), days + [*newest.values()],
                          users + [*newest], ads + no, counts + no)

    @staticmethod
    def _frame(kinds: list, days: list, *numbers: list) -> pd.DataFrame:
        """Rows of (kind, day, user, ad, n)."""
        out = {"kind": kinds, "us": 0, "area": None, "city": None, "event_id": 0, "day": days}
        nulls = np.full(len(kinds), NULL_BIT["event_id"] | NULL_BIT["us"])
        for name, values in zip(("user_id", "ads_id", "n"), numbers):
            if None in values:
                nulls |= np.array([NULL_BIT[name] if v is None else 0 for v in values])
                values = [0 if v is None else v for v in values]
            out[name] = np.array(values, dtype=np.int64)
        return pd.DataFrame({**out, "nulls": nulls})[SHARE_OUT]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = expiredTimerInfo.getExpiryTimeInMs()
        for cell in list(self.cells.keys()):
            if day_end(cell[0]) <= until:
                self.cells.removeKey(cell)
        return iter(())

    def close(self) -> None:
        pass


class PackedShare(BlacklistShare):
    """The same over blocks of clicks: Spark hands a processor its rows one by one, whatever they hold."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        return super().handleInputRows(key, unpacked(rows), timerValues)


def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(share, clicks): the clicks of a task as one block, an Arrow stream, per share and ``PACK_ROWS`` clicks."""
    held, n = [], 0
    for batch in batches:
        held, n = held + [batch], n + batch.num_rows
        if n >= PACK_ROWS:
            yield _blocks(held)
            held, n = [], 0
    if n:
        yield _blocks(held)


def _blocks(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(batches)
    share = t["share"].to_numpy()
    order = np.argsort(share, kind="stable")
    t = t.drop_columns("share").take(pa.array(order)).combine_chunks()
    shares, starts = np.unique(share[order], return_index=True)
    blocks = []
    for start, end in zip(starts, [*starts[1:], len(order)]):
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, t.schema) as w:
            w.write_table(t.slice(start, end - start))
        blocks.append(out.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(shares, pa.int64()), pa.array(blocks, pa.binary())], ["share", "clicks"])


def unpacked(rows: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The clicks of a share's blocks, in chunks of ``CHUNK_ROWS`` and at most one block more."""
    held, n = [], 0
    for pdf in rows:
        for block in pdf["clicks"]:
            held.append(pa.ipc.open_stream(block).read_all())
            n += held[-1].num_rows
            if n >= CHUNK_ROWS:
                yield pa.concat_tables(held).to_pandas()
                held, n = [], 0
    if n:
        yield pa.concat_tables(held).to_pandas()


def share_clicks(clicks: DataFrame, shares: int, ids: list[str]) -> DataFrame:
    """Clicks (``us``, ``day``) with the share of their user; nulls in ``ids`` are 0 and bits."""
    nulls = [F.when(F.col(c).isNull(), NULL_BIT[c]).otherwise(0) for c in ids]
    return clicks.select(F.pmod(F.xxhash64("user_id"), F.lit(shares)).alias("share"),
                         *[c for c in ("us", "area", "city", "day") if c not in ids],
                         *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ids],
                         sum(nulls[1:], nulls[0]).cast("bigint").alias("nulls"))


def without_null_bits(out: DataFrame) -> DataFrame:
    """Output rows of a share with their nulls again."""
    return out.select(*[F.when(F.col("nulls").bitwiseAND(NULL_BIT[c]) == 0, F.col(c)).alias(c) if c in NULL_BIT else c
                        for c in SHARE_OUT[:-1]])


def _share_rows(clicks: DataFrame, threshold: int, timed: bool, shares: int) -> DataFrame:
    """Output rows by shares of the users; ``clicks`` with ``us`` and ``day``."""
    c = share_clicks(clicks, shares, ["user_id", "ads_id", "event_id"])
    return without_null_bits(c.mapInArrow(packed, "share bigint, clicks binary").groupBy("share").transformWithStateInPandas(
        PackedShare(threshold, timed), OUT_SCHEMA + ", nulls bigint", "append", "EventTime" if timed else "None"))


def by_share(shares: int | None, ttl: str | None) -> bool:
    """Whether the state is laid out by share: a clock expires whole state values, so with it every cell is one."""
    return shares is not None and ttl is None


def blacklist_rows(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD, lateness: str | None = None,
                   ttl: str | None = None, shares: int | None = SHARES) -> DataFrame:
    """The stream of output rows of a stream of clicks."""
    if lateness is not None and ttl is not None:
        raise ValueError("cells are forgotten by the watermark or by the clock, not both")
    c = clicks.where(F.col("ts").isNotNull())
    if lateness is not None:
        c = c.withWatermark("ts", lateness)
    # the time goes on as a number, without the watermark's mark: Spark would drop every
    # click older than the lateness, the rule here goes by the end of its day
    c = c.select(F.unix_micros("ts").alias("us"), *CLICK[1:-1], F.date_format("ts", "yyyy-MM-dd").alias("day"))
    if by_share(shares, ttl):
        out = _share_rows(c, threshold, lateness is not None, shares)
    else:
        mode = "EventTime" if lateness is not None else "ProcessingTime" if ttl is not None else "None"
        step = Blacklist(threshold, lateness is not None, None if ttl is None else seconds(ttl) * 1000)
        out = c.groupBy("user_id").transformWithState(step, OUT_SCHEMA, "append", mode)
    return out.select("kind", F.timestamp_micros("us").alias("ts"), *CLICK[1:], "n")


def landing_task(files: int) -> Column:
    """The task that lands a row: one of ``files`` by user for the clicks, one of as many others for the rest."""
    return F.pmod(F.hash("user_id"), F.lit(files)) + F.when(F.col("kind") == "click", 0).otherwise(files)


def start_blacklist_cells(clicks: DataFrame, out_dir: str, checkpoint: str, threshold: int = BLACKLIST_THRESHOLD,
                          lateness: str | None = None, ttl: str | None = None,
                          trigger: dict | None = None, files: int | None = None,
                          shares: int | None = SHARES) -> StreamingQuery:
    """The streaming job: rows landed under ``log/batch_id=<b>/kind=<k>``, a file per
    state partition and kind, or ``files`` of clicks by user (for readers that count files)
    and, by other tasks, as many of the other kinds."""
    spark = prepare(clicks.sparkSession)
    if by_share(shares, ttl):
        mark_once(spark, checkpoint, "shares", str(shares))

    def sink(df: DataFrame, batch_id: int) -> None:
        df = df if files is None else df.repartitionById(2 * files, landing_task(files))
        land_once(df, os.path.join(out_dir, "log", f"batch_id={batch_id}"))

    return (blacklist_rows(clicks, threshold, lateness, ttl, shares).writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint).foreachBatch(sink)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


# --- readers -----------------------------------------------------------------------

def _log(spark: SparkSession, out_dir: str, kind: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(os.path.join(out_dir, "log")).where(F.col("kind") == kind)


def read_kept(spark: SparkSession, out_dir: str) -> DataFrame:
    return _log(spark, out_dir, "click").select(*CLICK, "batch_id")


def read_blocked(spark: SparkSession, out_dir: str) -> DataFrame:
    """user_id, blocked_day."""
    return _log(spark, out_dir, "block").select("user_id", F.col("day").alias("blocked_day"))


def read_late(spark: SparkSession, out_dir: str) -> DataFrame:
    return _log(spark, out_dir, "late").select(*CLICK, "batch_id")


def kept_stream(spark: SparkSession, out_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """The kept clicks as a file stream, for the totals and the sliding hour;
    ``files_per_trigger`` limits a micro-batch."""
    reader = spark.readStream.schema("ts timestamp, area string, city string, user_id bigint, ads_id bigint, event_id bigint")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(os.path.join(out_dir, "log", "*", "kind=click"))


def _state(spark: SparkSession, checkpoint: str, name: str, batch_id: int | None = None) -> tuple[DataFrame, bool]:
    """A state variable, and whether it is laid out by share."""
    reader = spark.read.format("statestore").option("stateVarName", name)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    s = reader.load(checkpoint)
    return s, "share" in s.schema["key"].dataType.names


def state_counts(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """user_id, ads_id, day, n from the state store, without the log."""
    s, shared = _state(spark, checkpoint, "cells", batch_id)
    if shared:
        v = F.col("user_map_value")
        s = s.select(F.col("user_map_key.day").alias("day"), F.inline(F.arrays_zip(
            v["users"].alias("user_id"), v["ads"].alias("ads_id"), v["counts"].alias("n"))))
        return s.select("user_id", "ads_id", "day", "n")
    return s.select("key.user_id", "user_map_key.ads_id", "user_map_key.day", F.col("user_map_value.n").alias("n"))


def state_blocked(spark: SparkSession, checkpoint: str) -> DataFrame:
    """user_id, blocked_day from the state store."""
    s, shared = _state(spark, checkpoint, "blocked")
    if shared:
        return s.select(F.inline(F.arrays_zip(F.col("value.users").alias("user_id"), F.col("value.days").alias("blocked_day"))))
    return s.select("key.user_id", F.col("value.day").alias("blocked_day"))
