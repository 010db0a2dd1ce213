"""Q7-Q10 from native state: blacklist cells, running totals, top ads, sliding hour."""

import os
import tempfile
import time
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from shoplens.plans import ads
from shoplens.sources.ads import read_ads_file_stream
from shoplens.sources.tables import ShopTables
from shoplens.streaming import blacklist, sliding, totals
from shoplens.streaming.runner import (AVAILABLE_NOW, _await, run_native_blacklist, run_native_sliding,
                                       run_native_totals)
from test_ads import clicks_df

BASE = 1_704_067_200_000  # 2024-01-01 UTC
HOUR, DAY, MINUTE = 3_600_000, 86_400_000, 60_000


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def run_dir():
    return tempfile.mkdtemp(prefix="run-")


def put(spark, src, i, rows):
    """File i of (ms, user, ad) clicks, newer than the earlier ones; event ids are i*100 and up."""
    path = os.path.join(src, f"w={i:04d}")
    spark.createDataFrame([(ms, "A", "c", u, a, i * 100 + k) for k, (ms, u, a) in enumerate(rows)],
                          "ts_ms bigint, area string, city string, user_id bigint, ads_id bigint, event_id bigint"
                          ).coalesce(1).write.parquet(path)
    for f in os.listdir(path):
        os.utime(os.path.join(path, f), (1_000_000 + i, 1_000_000 + i))


def stream_of(spark, src):
    return read_ads_file_stream(spark, os.path.join(src, "*")).select(
        "ts", "area", "city", "user_id", "ads_id", "event_id")


# --- a processor without Spark: state variables as dictionaries -----------------------

class Value:
    def __init__(self):
        self.v = None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v

    def clear(self):
        self.v = None


class Map(dict):
    def getValue(self, k):
        return self.get(k)

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        del self[k]


class Handle:
    def __init__(self):
        self.timers, self.maps, self.reads = set(), {}, 0

    def getMapState(self, name, *_, ttlDurationMs=None):
        return self.maps.setdefault(name, Map())

    def getValueState(self, name, *_):
        return self.maps.setdefault(name, Value())

    def registerTimer(self, t):
        self.timers.add(t)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getCurrentProcessingTimeInMs = getCurrentWatermarkInMs


class Fired:
    def __init__(self, t):
        self.t = t

    def getExpiryTimeInMs(self):
        return self.t


class Driver:
    """One key's processor, its micro-batches and its timers."""

    def __init__(self, step, key):
        self.step, self.key, self.handle, self.mark, self.out = step, (key,), Handle(), 0, []
        step.init(self.handle)

    def batch(self, rows, mark):
        """Rows first, then the timers up to the clock, as the engine does."""
        self.mark = max(self.mark, mark)
        clock = Clock(self.mark)
        got = list(self.step.handleInputRows(self.key, iter(rows), clock)) if rows else []
        for t in sorted(x for x in self.handle.timers if x <= self.mark):
            self.handle.timers.discard(t)
            got += list(self.step.handleExpiredTimer(self.key, clock, Fired(t)))
        rows = [r for f in got for r in (f.itertuples(index=False) if isinstance(f, pd.DataFrame) else [f])]
        self.out += rows
        return rows


def click_rows(clicks):
    """(ms, ad) clicks of a user as the rows the processor gets."""
    day = [pd.Timestamp(m, unit="ms").strftime("%Y-%m-%d") for m, _ in clicks]
    return [Row(us=m * 1000, area="A", city="c", user_id=1, ads_id=a, event_id=i, day=day[i])
            for i, (m, a) in enumerate(clicks)]


# --- Q7 -----------------------------------------------------------------------------

def simulated(batches, threshold):
    """Per batch, how many clicks are kept, by plain counting."""
    counts, blocked, kept = {}, False, []
    for b in batches:
        kept.append(0 if blocked else len(b))
        if not blocked:
            cells = [(m // DAY, a) for m, a in b]
            over = any(counts.get(c, 0) > threshold for c in cells)
            for c in cells:
                counts[c] = counts.get(c, 0) + 1
            blocked = over
    return kept


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 3 * DAY), st.integers(1, 3)), max_size=6), max_size=8),
       st.integers(0, 3))
def test_cells_equal_a_sequential_simulation(batches, threshold):
    d = Driver(blacklist.Blacklist(threshold, False, None), 1)
    got = []
    for b in batches:
        got.append(sum(r.kind == "click" for r in d.batch(click_rows(b), 0)))
    assert got == simulated(batches, threshold)


def test_state_stays_flat_over_200_batches():
    d = Driver(blacklist.Blacklist(10**6, True, None), 1)
    sizes, newest = [], 0
    for i in range(200):  # six hours each, three ads
        mark = newest - HOUR
        d.batch(click_rows([(BASE + i * 6 * HOUR + k * HOUR, 1 + k % 3) for k in range(5)]), mark)
        newest = BASE + i * 6 * HOUR + 4 * HOUR
        sizes.append(len(d.handle.maps["cells"]) + len(d.handle.timers))
    assert max(sizes[100:]) == max(sizes[8:100]) <= 10
    assert not any(r.kind == "late" for r in d.out)


def test_a_click_after_its_day_was_given_up_is_late_and_uncounted():
    d = Driver(blacklist.Blacklist(0, True, None), 1)
    d.batch(click_rows([(BASE + HOUR, 1)]), 0)
    got = d.batch(click_rows([(BASE + 2 * HOUR, 1), (BASE + 3 * DAY, 1)]), BASE + DAY)  # the day ended at the mark
    assert sorted(r.kind for r in got) == ["click", "count", "late"]
    assert list(d.handle.maps["cells"]) == [("2024-01-04", 1)] and d.handle.maps["blocked"].get() is None


def test_blacklist_stream_equals_closed_form_and_its_state(spark):
    h = 3600
    edge = [(i, 1, 1) for i in range(21)] + [(h, 1, 1), (2 * h, 1, 1)]
    edge += [(i, 2, 1) for i in range(20)] + [(h, 2, 1), (2 * h, 2, 1), (3 * h, 2, 1)]
    hot = [(i * 4 * h // 900, 7, 1 + i % 2) for i in range(900)]  # a third of the clicks and more
    c = clicks_df(spark, edge + hot)
    out = run_native_blacklist(c, run_dir(), h, 20, 2) + "/blacklist"
    kept = ads.ads_kept_clicks(c, h, 20)
    assert rows_of(blacklist.read_kept(spark, out + "/out"), "event_id") == rows_of(kept, "event_id")
    assert rows_of(blacklist.read_blocked(spark, out + "/out"), "user_id") == [(1,), (2,), (7,)]
    assert rows_of(blacklist.state_blocked(spark, out + "/checkpoint"), "user_id") == [(1,), (2,), (7,)]
    counts = kept.groupBy("user_id", "ads_id", "day").agg(F.count(F.lit(1)).alias("n"))
    names = ["user_id", "ads_id", "day", "n"]
    assert rows_of(blacklist.state_counts(spark, out + "/checkpoint"), *names) == rows_of(counts, *names)
    first = blacklist.state_counts(spark, out + "/checkpoint", 0).where("user_id = 1")  # after the first batch
    assert rows_of(first, *names) == [(1, 1, "2024-01-01", 21)]


def test_blacklist_with_lateness_gives_up_days_and_lands_late_clicks(spark):
    d = run_dir()
    days = [[(BASE + i * DAY + 2 * HOUR, u, 1) for u in (1, 2)] for i in range(6)]
    days[5].append((BASE + HOUR, 1, 1))  # five days late
    for i, rows in enumerate(days):
        put(spark, d + "/src", i, rows)
    q = blacklist.start_blacklist_cells(stream_of(spark, d + "/src"), d + "/out", d + "/ck", 20, lateness="2 hours",
                                        trigger=AVAILABLE_NOW)
    _await(q)
    assert rows_of(blacklist.read_late(spark, d + "/out"), "event_id", "user_id") == [(502, 1)]
    assert blacklist.read_kept(spark, d + "/out").count() == 12
    assert rows_of(blacklist.state_counts(spark, d + "/ck"), "user_id", "day") == [(1, "2024-01-06"), (2, "2024-01-06")]


def test_ttl_and_lateness_exclude_each_other(spark):
    with pytest.raises(ValueError):
        blacklist.blacklist_rows(stream_of(spark, "/root/testdata/sf0.001"), lateness="1 hour", ttl="1 hour")


class Calls(Map):
    """A map that counts its state calls."""
    made = 0

    def getValue(self, k):
        self.made += 1
        return super().getValue(k)

    def updateValue(self, k, v):
        self.made += 1
        super().updateValue(k, v)


def share_frame(clicks):
    """(ms, user, ad, event) clicks as a chunk of a share; None is 0 with its bit set."""
    ids = [[0 if c[i] is None else c[i] for c in clicks] for i in (1, 2, 3)]
    bits = [sum(bit for bit, v in zip((1, 2, 4), c[1:]) if v is None) for c in clicks]
    return pd.DataFrame({"share": 0, "us": [c[0] * 1000 for c in clicks], "area": "A", "city": None,
                         "day": [pd.Timestamp(c[0], unit="ms").strftime("%Y-%m-%d") for c in clicks],
                         "user_id": ids[0], "ads_id": ids[1], "event_id": ids[2], "nulls": bits})


def plain_rows(rows):
    """Output rows of a share or a user alike, in any order."""
    names = ["kind", "us", "user_id", "ads_id", "event_id", "day", "n"]
    nulls = lambda r, c: getattr(r, "nulls", 0) & blacklist.NULL_BIT.get(c, 0)
    return sorted((tuple(None if nulls(r, c) else getattr(r, c) for c in names) for r in rows), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 4 * DAY), st.sampled_from([None, 0, 1, 2**60 + 1]),
                                   st.sampled_from([None, 0, 5]), st.sampled_from([None, 7, 2**60 + 1])), max_size=8), max_size=6),
       st.integers(0, 2), st.booleans())
def test_a_share_gives_the_rows_of_its_users(batches, threshold, timed):
    share = Driver(blacklist.BlacklistShare(threshold, timed), 0)
    users, mark = {}, 0
    for batch in batches:
        got = share.batch([share_frame(batch[:3]), *([share_frame(batch[3:])] if batch[3:] else [])] if batch else [], mark)
        want = []
        for u in {*users, *(c[1] for c in batch)}:
            d = users.setdefault(u, Driver(blacklist.Blacklist(threshold, timed, None), u))
            mine = [c for c in batch if c[1] == u]
            days = share_frame(mine)["day"].tolist() if mine else []
            want += d.batch([Row(us=c[0] * 1000, area="A", city=None, user_id=u, ads_id=c[2], event_id=c[3], day=day)
                             for c, day in zip(mine, days)], mark)
        assert plain_rows(got) == plain_rows(want)
        mark = max([mark, *(c[0] - DAY for c in batch)])
    cells = {(day, u, a): n for (day,), v in share.handle.maps["cells"].items() for u, a, n in zip(*v)}
    assert cells == {(*cell[:1], u, cell[1]): n[0] for u, d in users.items() for cell, n in d.handle.maps["cells"].items()}


def test_state_calls_of_a_batch_follow_shares_and_days_not_cells():
    d = Driver(blacklist.BlacklistShare(10**6, False), 0)
    d.step.cells = d.handle.maps["cells"] = Calls()
    for _ in range(2):
        d.batch([share_frame([(BASE + day * DAY + u, u, u % 7, u) for u in range(500) for day in range(2)])], 0)
    assert d.step.cells.made == 2 * 2 * 2  # one read and one write per batch and day, for 1,000 cells
    assert sum(r.n == 2 for r in d.out if r.kind == "count") == 1000


def test_a_share_answers_a_chunk_by_two_frames_and_stores_blocks_of_numbers():
    d = Driver(blacklist.BlacklistShare(0, False), 0)
    chunk = share_frame([(BASE + day * DAY + u, u, 1, u) for u in range(50) for day in range(4)])
    for kinds in ({"click", "count"}, {"click", "count", "block"}):
        got = list(d.step.handleInputRows((0,), iter([chunk]), Clock(0)))
        assert len(got) == 2 and set(pd.concat(got)["kind"]) == kinds  # whatever the number of days
    users, ads_ids, counts = d.handle.maps["cells"][("2024-01-01",)]
    assert all(isinstance(x, array) for x in (users, ads_ids, counts)) and set(counts) == {2}
    d.batch([share_frame([(BASE, None, None, 1)])], 0)  # a null has no place in a block
    assert d.handle.maps["cells"][("2024-01-01",)][0][-1] is None


def share_batch(frame, share):
    """A chunk as Spark gives it to the packing: with strings that may be null, and its share."""
    return pa.RecordBatch.from_pandas(frame.assign(share=share), schema=pa.schema(
        [(c, pa.string() if c in ("area", "city", "day") else pa.int64()) for c in frame.columns]), preserve_index=False)


def test_a_task_gives_the_state_a_block_per_share_not_a_row_per_click(monkeypatch):
    clicks = [(BASE + k, None if k == 3 else k, k % 2, 2**60 + k) for k in range(400)]
    shares = np.array([k % 7 for k in range(400)])
    batches = [share_batch(share_frame(clicks[i:i + 100]), shares[i:i + 100]) for i in range(0, 400, 100)]
    blocks = pd.concat(b.to_pandas() for b in blacklist.packed(batches))
    assert blocks["share"].tolist() == list(range(7))
    for share, mine in blocks.groupby("share"):
        want = share_frame([c for c, x in zip(clicks, shares) if x == share]).drop(columns="share")
        pd.testing.assert_frame_equal(pd.concat(blacklist.unpacked([mine]))[want.columns], want, check_dtype=False)
    packed, plain = (Driver(cls(0, False), 0) for cls in (blacklist.PackedShare, blacklist.BlacklistShare))
    for _ in range(2):
        assert plain_rows(packed.batch([blocks], 0)) == plain_rows(plain.batch([share_frame(clicks)], 0))
    monkeypatch.setattr(blacklist, "PACK_ROWS", 150)
    assert len(list(blacklist.packed(batches))) == 2 and not list(blacklist.packed([]))
    monkeypatch.setattr(blacklist, "CHUNK_ROWS", 60)  # whatever the share holds, no more than a block over this
    assert [len(f) for f in blacklist.unpacked([blocks])] == [115, 114, 114, 57]


def test_both_layouts_of_the_state_give_the_same(spark):
    d = run_dir()
    rows = [[(BASE + i * 8 * HOUR + k, k % 11 or None, k % 3 or None) for k in range(60)] for i in range(4)]
    for i, batch in enumerate(rows):
        put(spark, d + "/src", i, batch)
    found = []
    for name, shares in (("user", None), ("share", 3)):
        out, ck = f"{d}/{name}", f"{d}/ck_{name}"
        _await(blacklist.start_blacklist_cells(stream_of(spark, d + "/src"), out, ck, 1, trigger=AVAILABLE_NOW, shares=shares))
        log = spark.read.schema(blacklist.LOG_SCHEMA).parquet(out + "/log").drop("city")
        found.append([sorted(map(str, f.collect())) for f in (
            log.select(sorted(log.columns)), blacklist.state_counts(spark, ck), blacklist.state_blocked(spark, ck))])
    assert found[0] == found[1] and len(found[0][2]) > 2
    with pytest.raises(RuntimeError, match="shares=3"):
        blacklist.start_blacklist_cells(stream_of(spark, d + "/src"), d + "/share", d + "/ck_share", 1, trigger=AVAILABLE_NOW)


# --- Q8, Q9, late clicks ---------------------------------------------------------------

LATE_BATCHES = [[(HOUR, 1)], [(2 * HOUR, 1), (DAY + HOUR, 2)], [(3 * HOUR, 1), (3 * DAY, 1)],
                [(4 * HOUR, 1), (DAY, 1), (3 * DAY, 2)], [(5 * HOUR, 1), (6 * HOUR, 1), (2 * DAY, 1)],
                [(5 * HOUR, 3), (5 * DAY, 1)]]


def late_by_hand(batches, delay):
    """Clicks whose day had ended at the watermark of the batch before theirs."""
    newest, marks, late = 0, [0, 0], []
    for i, b in enumerate(batches):
        late += [(i, m, a) for m, a in b if (BASE + m) // DAY * DAY + DAY <= marks[-2]]
        newest = max([newest, *[BASE + m for m, _ in b]])
        marks.append(max(0, newest - delay))
    return late


def test_totals_late_clicks_and_restart(spark):
    d = run_dir()
    for batches in ((0, 1, 2), (3, 4, 5)):  # the second start goes on from the checkpoint
        for i in batches:
            put(spark, d + "/src", i, [(BASE + m, 1, a) for m, a in LATE_BATCHES[i]])
        q = totals.start_totals(stream_of(spark, d + "/src"), d + "/out", d + "/ck", "1 day", trigger=AVAILABLE_NOW)
        _await(q)
    landed = totals.read_late(spark, d + "/out")
    late = landed.select(F.unix_millis("ts").alias("ms"), "ads_id")
    # the first start ends with an empty batch, so the next one is judged by its newer watermark
    got = {(r.ms - BASE, r.ads_id) for r in late.collect()}
    assert got == {(m, a) for b in LATE_BATCHES[3:] for m, a in b if m < 2 * DAY}
    counted = totals.read_totals(spark, d + "/out")
    assert counted.agg(F.sum("clicks")).first()[0] + late.count() == sum(map(len, LATE_BATCHES))
    # what the state refused is what landed: one key per grain
    keys = landed.where("batch_id >= 4").select("batch_id", "day", "area", "city", "ads_id").distinct().count()
    assert totals.dropped_keys(q) == 2 * keys > 0


def test_late_clicks_follow_the_rule(spark):
    d = run_dir()
    for i, b in enumerate(LATE_BATCHES):
        put(spark, d + "/src", i, [(BASE + m, 1, a) for m, a in b])
    q = totals.start_totals(stream_of(spark, d + "/src"), d + "/out", d + "/ck", "1 day", trigger=AVAILABLE_NOW)
    _await(q)
    got = rows_of(totals.read_late(spark, d + "/out"), "batch_id", F.unix_millis("ts") - BASE, "ads_id")
    assert got == sorted(late_by_hand(LATE_BATCHES, DAY)) and len(got) == 3
    on_time = [(m, a) for i, b in enumerate(LATE_BATCHES) for m, a in b if (i, m, a) not in got]
    want = {}
    for m, a in on_time:
        want[m // DAY, a] = want.get((m // DAY, a), 0) + 1
    days = {f"2024-01-{k + 1:02d}": k for k in range(9)}
    assert {(days[r.day], r.ads_id): r.clicks for r in totals.read_totals(spark, d + "/out").collect()} == want


def test_totals_top_and_open_days_equal_batch(spark):
    c = ShopTables(spark, "/root/testdata/sf0.001").ads(6).where("ts < timestamp'2024-01-09'")
    folder = run_dir()
    run_native_blacklist(c, folder, 40 * 3600, 10**6, 2)
    run_native_totals(spark, folder, "1 day", 2, 2)
    out, ck = folder + "/totals/out", folder + "/totals/checkpoint"
    want = ads.ads_daily_totals(c)
    names = ["day", "area", "city", "ads_id", "clicks"]
    assert rows_of(totals.read_totals(spark, out), *names) == rows_of(want, *names)
    top = ["day", "area", "ads_id", "clicks", "rank"]
    assert rows_of(totals.read_top(spark, out), *top) == rows_of(ads.ads_area_top(want), *top)
    newest = c.agg(F.max("ts")).first()[0]
    still = want.where(F.to_timestamp("day") + F.expr("interval 1 day") > F.lit(newest) - F.expr("interval 1 day"))
    assert rows_of(totals.state_totals(spark, ck), *names) == rows_of(still, *names) != []
    one = rows_of(still, *names)[0]
    found = totals.state_totals(spark, ck).where((F.col("day") == one[0]) & (F.col("city") == one[2]) & (F.col("ads_id") == one[3]))
    assert (one in rows_of(found, *names)) and totals.read_late(spark, out).count() == 0


def test_a_batch_ranks_only_what_it_touches(spark):
    """300 ads in a day; later batches touch one: the lists they start from have three rows."""
    d = run_dir()
    put(spark, d + "/src", 0, [(BASE + a, 1, a) for a in range(300)])
    put(spark, d + "/src", 1, [(BASE + HOUR, 1, 250)] * 2)
    put(spark, d + "/src", 2, [(BASE + 2 * HOUR, 1, 4)])
    _await(totals.start_totals(stream_of(spark, d + "/src"), d + "/out", d + "/ck", trigger=AVAILABLE_NOW))
    log = spark.read.schema(totals.LOG_SCHEMA).parquet(d + "/out/log")
    assert rows_of(log.where("kind = 'total'").groupBy("batch_id").count(), "batch_id", "count") == [(0, 300), (1, 1), (2, 1)]
    assert [r[1:] for r in rows_of(log.where("kind = 'top' and batch_id = 2"), "rank", "ads_id", "clicks")] == \
        [(250, 3), (4, 2), (0, 1)]
    plan = totals.running_totals(stream_of(spark, d + "/src"), "1 day")
    assert plan.isStreaming


@pytest.mark.parametrize("text, want", [("1 day", 86400), ("90 minutes", 5400), (" 2 hours", 7200), ("10 seconds", 10)])
def test_intervals(text, want):
    assert totals.seconds(text) == want
    with pytest.raises(ValueError):
        totals.seconds("soon")


# --- Q10 ----------------------------------------------------------------------------

def slides_by_hand(clicks, slide, length, until):
    """{(slide, minute): clicks} by going through every click and slide."""
    pane, out = min(slide, MINUTE), {}
    for m in clicks:
        label, end = m // MINUTE * MINUTE, m // pane * pane + pane
        at = -(-end // slide) * slide
        while at <= until and at <= label + length:
            out[at, label] = out.get((at, label), 0) + 1
            at += slide
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40 * MINUTE), max_size=8), min_size=1, max_size=5),
       st.sampled_from([10_000, 30_000, MINUTE, 5 * MINUTE]), st.sampled_from([5 * MINUTE, 60 * MINUTE]))
def test_ring_equals_every_slide_by_hand(gaps, slide, length):
    d = Driver(sliding.SlidingHour(min(slide, MINUTE), slide, length, False), 1)
    at, clicks, newest = BASE, [], 0
    for batch in gaps:  # clicks come in time order over the batches
        ms = sorted(at + x for x in batch)
        d.batch([pd.DataFrame({"ms": ms[:3]}), pd.DataFrame({"ms": ms[3:]})] if ms else [], newest)
        clicks += ms
        newest = max([newest, *ms])
        at = max([at, *ms])
    d.batch([], newest)
    got = {}
    for r in d.out:
        assert r.kind == "slide" and (r.slide_ms, r.minute_ms) not in got
        got[r.slide_ms, r.minute_ms] = r.clicks
    assert got == slides_by_hand(clicks, slide, length, newest)
    ring = d.handle.maps["ring"].get()
    assert ring is None or all(x >= newest - length - slide for x in ring[1])


def test_ring_is_bounded_and_late_clicks_go_aside():
    d = Driver(sliding.SlidingHour(MINUTE, MINUTE, 60 * MINUTE, False), 1)
    for i in range(300):
        d.batch([pd.DataFrame({"ms": [BASE + i * MINUTE + 5]})], BASE + (i - 1) * MINUTE)
    ring = d.handle.maps["ring"].get()
    assert len(ring[0]) <= 63
    got = d.batch([pd.DataFrame({"ms": [BASE, BASE + 299 * MINUTE]})], BASE + 299 * MINUTE)
    assert [(r.kind, r.minute_ms, r.clicks) for r in got if r.kind == "late"] == [("late", BASE, 1)]


def test_ring_by_arrival_keeps_old_labels_for_the_hour():
    d = Driver(sliding.SlidingHour(10_000, 10_000, 60_000, True), 1)
    old = BASE - 5 * DAY  # an old click counts from when it comes, under its own minute
    d.batch([pd.DataFrame({"ms": [old, old, BASE]})], BASE + 1)
    out = []
    for k in range(1, 10):
        out += d.batch([], BASE + k * 10_000)
    assert {(r.slide_ms - BASE) // 10_000 for r in out} == set(range(1, 7))
    assert {(r.minute_ms, r.clicks) for r in out} == {(old, 2), (BASE, 1)}
    assert d.handle.maps["ring"].get() is None


def test_sliding_stream_equals_slides_by_hand(spark):
    c = ShopTables(spark, "/root/testdata/sf0.001").ads(2).where("ts < timestamp'2024-01-05'")
    folder = run_dir()
    run_native_blacklist(c, folder, 40 * 3600, 10**6, 2)
    run_native_sliding(spark, folder, "5 minutes", "10 minutes", 2, 2)
    out = folder + "/sliding/out"
    ms = {}
    for r in c.select("ads_id", F.unix_millis("ts").alias("ms")).collect():
        ms.setdefault(r.ads_id, []).append(r.ms)
    until = max(x for v in ms.values() for x in v) - 10 * MINUTE
    want = sorted((ad, s, m, n) for ad, v in ms.items()
                  for (s, m), n in slides_by_hand(v, 5 * MINUTE, 60 * MINUTE, until).items())
    assert rows_of(sliding.read_slides(spark, out), "ads_id", "slide_ms", "minute_ms", "clicks") == want != []
    last = max(r[1] for r in want)
    shown = {r.ads_id: r.minutes for r in sliding.read_last_slide_json(spark, out).collect()}
    assert set(shown) == {r[0] for r in want if r[1] == last} and sliding.read_late(spark, out).count() == 0


def test_sliding_stream_by_arrival_runs_on_the_clock(spark):
    d = run_dir()
    put(spark, d + "/src", 0, [(BASE, 1, 5), (BASE + 1, 2, 5), (BASE + 2 * MINUTE, 1, 5)])
    q = sliding.start_sliding(stream_of(spark, d + "/src"), d + "/out", d + "/ck", "1 second", "5 seconds",
                              arrival=True, parts=2, trigger={"processingTime": "1 second"})
    try:
        end = time.time() + 60
        while time.time() < end:
            time.sleep(2)
            if os.path.exists(d + "/out/log") and sliding.read_slides(spark, d + "/out").count():
                break
    finally:
        q.stop()
    first = sliding.read_slides(spark, d + "/out").groupBy("slide_ms").agg(F.sum("clicks").alias("n")).collect()
    assert first and max(r.n for r in first) <= 3
    assert {r.minute_ms for r in sliding.read_slides(spark, d + "/out").collect()} <= {BASE, BASE + 2 * MINUTE}


def test_a_slide_that_does_not_fit_minutes_is_refused(spark):
    with pytest.raises(ValueError):
        sliding.sliding_rows(stream_of(spark, "/root/testdata/sf0.001"), "7 seconds")


def test_a_complete_batch_is_not_written_again(spark):
    from shoplens.streaming.landing import land_once
    path = run_dir() + "/batch_id=0"
    df = spark.range(3).selectExpr("id", "'click' as kind")
    land_once(df, path)
    names = sorted(os.listdir(path + "/kind=click"))
    land_once(df, path)
    assert sorted(os.listdir(path + "/kind=click")) == names
    os.unlink(path + "/_SUCCESS")  # a try that did not come to its end
    land_once(df, path)
    assert sorted(os.listdir(path + "/kind=click")) != names and spark.read.parquet(path).count() == 3


def test_more_tasks_land_no_more_files(spark, monkeypatch):
    """Later queries count files: a micro-batch lands as many as before, by user."""
    from shoplens.streaming import runner
    monkeypatch.setattr(runner, "CELL_ROWS", 5)
    d = run_dir()
    run_native_blacklist(clicks_df(spark, [(i * 60, i, 1) for i in range(60)]), d, 3600, 20, 2)
    with open(d + "/blacklist/checkpoint/offsets/0") as f:
        assert '"spark.sql.shuffle.partitions":"12"' in f.read()
    landed = os.listdir(d + "/blacklist/out/log/batch_id=0/kind=click")
    assert len([x for x in landed if x.endswith(".parquet")]) == 2
    assert blacklist.read_kept(spark, d + "/blacklist/out").count() == 60


def test_counts_are_landed_by_other_tasks_than_the_clicks(spark):
    d = run_dir()
    run_native_blacklist(clicks_df(spark, [(i, i, 1) for i in range(60)]), d, 3600, 20, 2)
    tasks = {kind: {x.split("-")[1] for x in os.listdir(f"{d}/blacklist/out/log/batch_id=0/kind={kind}") if x.endswith(".parquet")}
             for kind in ("click", "count")}
    assert tasks == {"click": {"00000", "00001"}, "count": {"00002", "00003"}}
    users = spark.read.parquet(d + "/blacklist/out/log/batch_id=0/kind=click").groupBy(F.input_file_name()).agg(
        F.collect_set(F.expr("pmod(hash(user_id), 2)")).alias("parts")).collect()
    assert sorted(r.parts for r in users) == [[0], [1]]  # of the clicks, the same users in a file as ever
