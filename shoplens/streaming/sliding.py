"""Clicks per ad and minute in the hour before every slide (Q10), emitted as a stream.

A stateful processor keyed by ad (and by ``parts`` shares of its users, so a hot
ad is spread) keeps a ring of panes: the clicks of each ``pane`` of the clock and
minute label, as three parallel arrays in one state value. When the clock passes
a slide boundary a timer fires; the slides up to it are emitted in order: panes
that have come into the hour are added to the minute counts, panes that have
left it are taken out, and what remains is the result of that slide. A slide so
costs the panes that move, not the clicks of the hour. Panes that no later slide
can hold are dropped from the ring, and an empty ring sets no timer.

Two clocks:

- event time (``arrival=False``): a slide s holds the minutes that begin in
  [s - length, s), counted up to s; it is emitted when the watermark passes s.
  The pane is the slide or a minute, whichever is shorter, so a slide inside a
  minute counts that minute's clicks so far. A click too old for any slide to
  come is emitted as ``late``;
- arrival (``arrival=True``): a click belongs to the slide in which it arrives
  and stays for ``length``; labels are still the minutes of the click's own
  time. Slides are emitted by the clock of the cluster while the query runs.

One write per micro-batch under ``log/batch_id=<b>/kind=<slide|late>``; readers
sum the parts.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from shoplens.functions import pairs_json
from shoplens.session import prepare
from shoplens.streaming.landing import land_once
from shoplens.streaming.totals import seconds

MINUTE_MS = 60_000
OUT = ["kind", "ads_id", "slide_ms", "minute_ms", "clicks"]
OUT_SCHEMA = "kind string, ads_id bigint, slide_ms bigint, minute_ms bigint, clicks bigint"
CHUNK = 20_000  # rows of a slide result given to Spark at once
# the processor goes to the workers by value: they need no installation of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Ring:
    """Panes (clock, minute label, clicks) in the order of the clock, and the next slide to emit."""

    def __init__(self, clocks=(), labels=(), counts=(), following: int | None = None):
        self.cells = {(c, x): n for c, x, n in zip(clocks, labels, counts)}
        self.following = following

    def add(self, clocks: np.ndarray, labels: np.ndarray) -> None:
        pairs, n = np.unique(np.stack([clocks, labels]), axis=1, return_counts=True)
        for c, x, k in zip(*pairs.tolist(), n.tolist()):
            self.cells[c, x] = self.cells.get((c, x), 0) + k

    def state(self) -> tuple:
        rows = sorted((c, x, n) for (c, x), n in self.cells.items())
        clocks, labels, counts = map(list, zip(*rows)) if rows else ([], [], [])
        return clocks, labels, counts, self.following

    def emit(self, until: int, pane: int, slide: int, length: int, by_label: bool) -> Iterator[tuple[int, int, int]]:
        """(slide, minute, clicks) of every slide up to ``until`` with clicks, and
        the ring without what no later slide holds."""
        clocks, labels, counts, _ = self.state()
        anchors = labels if by_label else clocks
        coming = leaving = 0
        minutes: dict[int, int] = {}
        at = self.following
        while at is not None and at <= until:
            while coming < len(clocks) and clocks[coming] + pane <= at:
                minutes[labels[coming]] = minutes.get(labels[coming], 0) + counts[coming]
                coming += 1
            while leaving < coming and anchors[leaving] < at - length:
                minutes[labels[leaving]] -= counts[leaving]
                if not minutes[labels[leaving]]:
                    del minutes[labels[leaving]]
                leaving += 1
            for minute, n in minutes.items():
                yield at, minute, n
            if minutes:
                at += slide
            elif coming < len(clocks):  # nothing in the hour: on to the next pane's slide
                at = max(at + slide, -(-(clocks[coming] + pane) // slide) * slide)
            else:
                at = None
        # panes that the next slide has already lost are given up
        if at is not None:
            self.cells = {(c, x): n for (c, x), n in self.cells.items() if (x if by_label else c) >= at - length}
        if at is None or not self.cells:
            self.cells, at = {}, None
        self.following = at


class SlidingHour(StatefulProcessor):
    def __init__(self, pane: int, slide: int, length: int, arrival: bool):
        self.pane, self.slide, self.length, self.arrival = pane, slide, length, arrival

    def init(self, handle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", "clocks array<bigint>, labels array<bigint>, counts array<bigint>, "
                                                 "following bigint")

    def _clock(self, timerValues) -> int:
        return timerValues.getCurrentProcessingTimeInMs() if self.arrival else timerValues.getCurrentWatermarkInMs()

    def _load(self) -> Ring:
        known = self.ring.get()
        return Ring(*known) if known else Ring()

    def _save(self, ring: Ring) -> None:
        if ring.following is None:
            self.ring.clear()
        else:
            self.ring.update(ring.state())
            self.handle.registerTimer(ring.following)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ring, clock = self._load(), self._clock(timerValues)
        passed = clock // self.slide * self.slide  # slides up to here are over
        first = None
        for pdf in rows:
            ms = pdf["ms"].to_numpy(dtype=np.int64)
            labels = ms // MINUTE_MS * MINUTE_MS
            if self.arrival:
                clocks = np.full(len(ms), clock // self.pane * self.pane, dtype=np.int64)
            else:
                late = labels < passed + self.slide - self.length
                if late.any():
                    at, n = np.unique(labels[late], return_counts=True)
                    yield pd.DataFrame({"kind": "late", "ads_id": key[0], "slide_ms": pd.array([pd.NA] * len(at), "Int64"),
                                        "minute_ms": at, "clicks": n})[OUT]
                ms, labels = ms[~late], labels[~late]
                clocks = ms // self.pane * self.pane
            if len(ms):
                ring.add(clocks, labels)
                first = int(clocks.min()) if first is None else min(first, int(clocks.min()))
        if first is not None:
            slide = max(-(-(first + self.pane) // self.slide) * self.slide, passed + self.slide)
            ring.following = slide if ring.following is None else min(ring.following, slide)
            self._save(ring)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        warnings.simplefilter("ignore", FutureWarning)
        ring = self._load()
        until = self._clock(timerValues) // self.slide * self.slide
        if ring.following is None or ring.following > until:  # a timer of a slide that is out already
            return
        held: list[tuple[int, int, int]] = []
        for row in ring.emit(until, self.pane, self.slide, self.length, not self.arrival):
            held.append(row)
            if len(held) == CHUNK:
                yield self._frame(key, held)
                held = []
        if held:
            yield self._frame(key, held)
        self._save(ring)

    @staticmethod
    def _frame(key, rows) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=OUT[2:]).assign(kind="slide", ads_id=key[0])[OUT]

    def close(self) -> None:
        pass


def sliding_rows(clicks: DataFrame, slide: str = "10 seconds", length: str = "60 minutes", lateness: str = "1 minute",
                 arrival: bool = False, parts: int = 8) -> DataFrame:
    """The stream of output rows of a stream of clicks (ts, user_id, ads_id)."""
    slide_ms, length_ms = seconds(slide) * 1000, seconds(length) * 1000
    if not (MINUTE_MS % slide_ms == 0 or slide_ms % MINUTE_MS == 0):
        raise ValueError("the slide divides a minute or is a number of minutes")
    c = clicks.where(F.col("ts").isNotNull())
    if not arrival:
        c = c.withWatermark("ts", lateness)
    c = c.select("ads_id", F.pmod(F.xxhash64("user_id"), F.lit(parts)).alias("part"), F.unix_millis("ts").alias("ms"))
    pane = slide_ms if arrival else min(slide_ms, MINUTE_MS)
    step = SlidingHour(pane, slide_ms, length_ms, arrival)
    return c.groupBy("ads_id", "part").transformWithStateInPandas(
        step, OUT_SCHEMA, "append", "ProcessingTime" if arrival else "EventTime")


def start_sliding(clicks: DataFrame, out_dir: str, checkpoint: str, slide: str = "10 seconds",
                  length: str = "60 minutes", lateness: str = "1 minute", arrival: bool = False, parts: int = 8,
                  trigger: dict | None = None) -> StreamingQuery:
    """The streaming job; read it with ``read_slides``."""
    prepare(clicks.sparkSession)

    def sink(df: DataFrame, batch_id: int) -> None:
        land_once(df, os.path.join(out_dir, "log", f"batch_id={batch_id}"))

    return (sliding_rows(clicks, slide, length, lateness, arrival, parts).writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint).foreachBatch(sink)
            .trigger(**(trigger or {"processingTime": slide})).start())


def _log(spark: SparkSession, out_dir: str, kind: str) -> DataFrame:
    log = spark.read.schema(OUT_SCHEMA + ", batch_id bigint").parquet(os.path.join(out_dir, "log"))
    return log.where(F.col("kind") == kind)


def read_slides(spark: SparkSession, out_dir: str) -> DataFrame:
    """ads_id, slide_ms (end of the slide), minute_ms (start of the minute), clicks."""
    return (_log(spark, out_dir, "slide").groupBy("ads_id", "slide_ms", "minute_ms")
            .agg(F.sum("clicks").alias("clicks")))


def read_late(spark: SparkSession, out_dir: str) -> DataFrame:
    """ads_id, minute_ms, clicks of clicks that no slide could hold any more."""
    return _log(spark, out_dir, "late").groupBy("ads_id", "minute_ms").agg(F.sum("clicks").alias("clicks"))


def read_last_slide_json(spark: SparkSession, out_dir: str) -> DataFrame:
    """ads_id, minutes: ``[{"HH:mm":clicks},...]`` of the newest slide, in time order;
    an ad without clicks in that hour has no row."""
    s = read_slides(spark, out_dir)
    last = s.agg(F.max("slide_ms")).scalar()
    label = F.date_format(F.timestamp_millis("minute_ms"), "HH:mm")
    g = s.where(F.col("slide_ms") == last).groupBy("ads_id").agg(F.sort_array(F.collect_list(F.struct(
        "minute_ms", label.alias("k"), F.col("clicks").alias("v")))).alias("_l"))
    return g.select("ads_id", pairs_json("_l").alias("minutes"))
