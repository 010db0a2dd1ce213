import datetime as dt
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shoplens.plans import ads
from shoplens.sources.tables import ShopTables
from shoplens.streaming import ads_stream as S
from shoplens.streaming.runner import AVAILABLE_NOW, _await, run_ads_pipeline
from test_ads import clicks_df


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


VARIANTS = ["tables", "state"]


@pytest.mark.parametrize("stage1", VARIANTS)
def test_stream_blacklist_edge_rows(spark, stage1):
    h = 3600
    rows = [(i, 1, 1) for i in range(21)] + [(h, 1, 1), (2 * h, 1, 1)]
    rows += [(i, 2, 1) for i in range(20)] + [(h, 2, 1), (2 * h, 2, 1), (3 * h, 2, 1)]
    c = clicks_df(spark, rows)
    out = run_ads_pipeline(c, tempfile.mkdtemp(prefix="run-"), h, 20, stage1=stage1)
    blocked = {r.user_id: r.blocked_day for r in S.read_blocked(spark, out).collect()}
    assert blocked == {1: "2024-01-01", 2: "2024-01-01"}
    assert _rows(S.read_kept(spark, out), ["event_id"]) == \
        _rows(ads.ads_kept_clicks(c, h, 20), ["event_id"])
    counts = {(r.user_id, r.ads_id): r.n for r in S.read_user_ad_counts(spark, out).collect()}
    assert counts == {(1, 1): 22, (2, 1): 22}


@pytest.mark.parametrize("stage1", VARIANTS)
def test_stream_equals_batch(spark, stage1):
    c = ShopTables(spark, "/root/testdata/sf0.001").ads(2).where("ts < timestamp'2024-01-09'")
    secs = 12 * 3600  # a (user, ad, day) key spans two micro-batches, so users are blocked
    out = run_ads_pipeline(c, tempfile.mkdtemp(prefix="run-"), secs, 1, stage1=stage1)
    kept = ads.ads_kept_clicks(c, secs, 1)
    blocked = {r.user_id for r in S.read_blocked(spark, out).collect()}
    assert blocked == {r.user_id for r in ads.ads_blacklist(c, secs, 1).collect()} and blocked
    assert kept.count() < c.count()
    assert _rows(S.read_kept(spark, out), ["event_id"]) == _rows(kept, ["event_id"])
    tot = ads.ads_daily_totals(kept)
    cols = ["day", "area", "city", "ads_id", "clicks"]
    assert _rows(S.read_daily_totals(spark, out), cols) == _rows(tot, cols)
    cols = ["day", "area", "ads_id", "clicks", "rank"]
    assert _rows(S.read_area_top(spark, out), cols) == _rows(ads.ads_area_top(tot), cols)
    cols = ["ads_id", "minute", "clicks"]
    assert _rows(S.read_last_hour(spark, out), cols) == _rows(ads.ads_last_hour(kept), cols)


def test_last_hour_keeps_the_cut_minute(spark):
    rows = [(30, 1, 1), (45, 2, 1), (59, 3, 2), (3600 + 40, 4, 1)]  # newest 01:00:40
    c = clicks_df(spark, rows)
    out = run_ads_pipeline(c, tempfile.mkdtemp(prefix="run-"), 1800, 20)
    got = {(r.ads_id, r.minute, r.clicks) for r in S.read_last_hour(spark, out).collect()}
    assert got == {(1, "00:00", 1), (2, "00:00", 1), (1, "01:00", 1)}


@pytest.mark.parametrize("stage1", VARIANTS)
def test_late_click_adds_to_its_own_day(spark, stage1):
    from shoplens.sources.ads import read_ads_file_stream
    d = tempfile.mkdtemp(prefix="run-")
    src = os.path.join(d, "clicks")
    schema = "ts_ms bigint, area string, city string, user_id bigint, ads_id bigint, event_id bigint"
    day2 = int(dt.datetime(2024, 1, 2, 12, tzinfo=dt.timezone.utc).timestamp() * 1000)
    late = int(dt.datetime(2023, 1, 1, 23, tzinfo=dt.timezone.utc).timestamp() * 1000)
    for i, (ms, eid) in enumerate([(day2, 1), (late, 2)]):  # the late click comes second
        spark.createDataFrame([(ms, "A", "c", 1, 1, eid)], schema).coalesce(1) \
            .write.parquet(os.path.join(src, f"w={i:03d}"))
    clicks = read_ads_file_stream(spark, src).select("ts", "area", "city", "user_id", "ads_id",
                                                     "event_id")
    start = S.start_blacklist_tables if stage1 == "tables" else S.start_blacklist
    q = start(clicks, os.path.join(d, "out"), os.path.join(d, "ck"), threshold=20, trigger=AVAILABLE_NOW)
    _await(q)
    assert len(q.recentProgress) >= 2  # two micro-batches: the late click arrived later
    got = _rows(S.read_daily_totals(spark, os.path.join(d, "out")), ["day", "clicks"])
    assert got == [("2023-01-01", 1), ("2024-01-02", 1)]


@pytest.mark.parametrize("stage1", VARIANTS)
def test_text_lines_stream_with_bad_lines(spark, stage1):
    d = tempfile.mkdtemp(prefix="run-")
    src = os.path.join(d, "lines")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("1704067200000 A c 1 5\n1704067200000 A c 1\nxx A c 1 5\n"
                "1704067260000 A c 2 5 extra\n")
    lines = spark.readStream.text(src)
    good, bad_q = S.clicks_from_lines(lines, os.path.join(d, "bad"), os.path.join(d, "ck_bad"))
    start = S.start_blacklist_tables if stage1 == "tables" else S.start_blacklist
    q = start(good, os.path.join(d, "out"), os.path.join(d, "ck1"), threshold=20,
              trigger=AVAILABLE_NOW)
    _await(q)
    bad_q.processAllAvailable()
    bad_q.stop()
    kept = S.read_kept(spark, os.path.join(d, "out"))
    assert _rows(kept, ["user_id", "ads_id"]) == [(1, 5), (2, 5)]
    reasons = sorted(r.reason for r in spark.read.parquet(os.path.join(d, "bad")).collect())
    assert reasons == ["fewer than 5 fields", "time is not an integer"]


def test_idle_user_state_times_out_blocked_user_stays(spark):
    from shoplens.streaming.replay import read_replay, write_replay
    d = tempfile.mkdtemp(prefix="run-")
    day = 86400
    # user 1 is blocked on day 0 (threshold 0: 2nd batch sees 1 > 0), user 2 clicks
    # once on day 0 and goes idle, user 3 clicks on days 10 and 11
    rows = [(0, 1, 1), (3600, 1, 1), (60, 2, 1), (10 * day, 3, 1), (11 * day, 3, 1),
            (12 * day, 3, 1)]
    c = clicks_df(spark, rows)
    write_replay(c, os.path.join(d, "replay"), 3600)
    q = S.start_blacklist(read_replay(spark, os.path.join(d, "replay")), os.path.join(d, "out"),
                          os.path.join(d, "ck"), threshold=0, keep_days=3, lateness="1 day",
                          trigger=AVAILABLE_NOW)
    _await(q)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress
              if p.get("stateOperators")]
    # at the end: user 1 (blocked, kept for good) and user 3; user 2 timed out
    assert states[-1] == 2
    assert {r.user_id for r in S.read_blocked(spark, os.path.join(d, "out")).collect()} == {1}


def test_resume_without_the_log_is_refused(spark):
    from shoplens.streaming.replay import read_replay, write_replay
    d = tempfile.mkdtemp(prefix="run-")
    c = clicks_df(spark, [(0, 1, 1), (3600, 1, 1)])
    write_replay(c, os.path.join(d, "replay"), 3600)
    ck = os.path.join(d, "ck")
    q = S.start_blacklist_tables(read_replay(spark, os.path.join(d, "replay")),
                                 os.path.join(d, "out"), ck, threshold=0, trigger=AVAILABLE_NOW)
    _await(q)
    with pytest.raises(RuntimeError, match="log is missing"):
        S.start_blacklist_tables(read_replay(spark, os.path.join(d, "replay")),
                                 os.path.join(d, "other_out"), ck, threshold=0,
                                 trigger=AVAILABLE_NOW)


def test_hot_user_through_the_table_form_equals_closed_form(spark):
    # user 7 holds a third of the clicks, spread over four 1-hour micro-batches
    h = 3600
    rows = [(i * 4 * h // 3000, 7, 1 + i % 2) for i in range(3000)]
    rows += [(i * 4 * h // 6000, 100 + i % 50, 1 + i % 2) for i in range(6000)]
    c = clicks_df(spark, rows)
    out = run_ads_pipeline(c, tempfile.mkdtemp(prefix="run-"), h, 500, stage1="tables")
    assert _rows(S.read_kept(spark, out), ["event_id"]) == \
        _rows(ads.ads_kept_clicks(c, h, 500), ["event_id"])
    blocked = {r.user_id for r in S.read_blocked(spark, out).collect()}
    assert blocked == {r.user_id for r in ads.ads_blacklist(c, h, 500).collect()} == {7}


def test_new_checkpoint_on_an_existing_log_is_refused(spark):
    from shoplens.streaming.replay import read_replay, write_replay
    d = tempfile.mkdtemp(prefix="run-")
    out = os.path.join(d, "out")
    write_replay(clicks_df(spark, [(0, 1, 1), (3600, 1, 1), (7200, 1, 1)]), os.path.join(d, "replay"), 3600)
    source = lambda: read_replay(spark, os.path.join(d, "replay"))
    _await(S.start_blacklist_tables(source(), out, os.path.join(d, "ck"), threshold=0, trigger=AVAILABLE_NOW))
    before = _rows(S.read_kept(spark, out), ["event_id"])
    for start in (S.start_blacklist_tables, S.start_blacklist):
        with pytest.raises(RuntimeError, match="holds landed batches"):
            start(source(), out, os.path.join(d, "fresh"), threshold=0, trigger=AVAILABLE_NOW)
    # its own checkpoint goes on, and nothing landed is lost
    _await(S.start_blacklist_tables(source(), out, os.path.join(d, "ck"), threshold=0, trigger=AVAILABLE_NOW))
    assert _rows(S.read_kept(spark, out), ["event_id"]) == before and len(before) == 2


def _hourly(spark, n):
    """n windows of one hour; user 1 clicks in each, others come and go."""
    rows = [(i * 3600 + 5, 1, 1 + i % 3) for i in range(n)]
    rows += [(i * 3600 + 9, 10 + i % 7, 1 + i % 2) for i in range(n)]
    return clicks_df(spark, rows)


@pytest.mark.parametrize("every", [1, 3, 100])
def test_snapshots_change_cost_not_result(spark, every):
    from shoplens.streaming.replay import read_replay, write_replay
    d = tempfile.mkdtemp(prefix="run-")
    c = _hourly(spark, 8)
    write_replay(c, os.path.join(d, "replay"), 3600)
    q = S.start_blacklist_tables(read_replay(spark, os.path.join(d, "replay")), os.path.join(d, "out"),
                                 os.path.join(d, "ck"), threshold=1, trigger=AVAILABLE_NOW, snapshot_every=every)
    _await(q)
    want = ads.ads_kept_clicks(c, 3600, 1)
    out = os.path.join(d, "out")
    assert _rows(S.read_kept(spark, out), ["event_id"]) == _rows(want, ["event_id"])
    cols = ["day", "area", "ads_id", "clicks", "rank"]
    assert _rows(S.read_area_top(spark, out), cols) == _rows(ads.ads_area_top(ads.ads_daily_totals(want)), cols)


def test_index_after_restart_equals_the_running_one(spark):
    from shoplens.streaming.replay import read_replay, write_replay
    d = tempfile.mkdtemp(prefix="run-")
    write_replay(_hourly(spark, 7), os.path.join(d, "replay"), 3600)
    out = os.path.join(d, "out")
    _await(S.start_blacklist_tables(read_replay(spark, os.path.join(d, "replay")), out, os.path.join(d, "ck"),
                                    threshold=1, trigger=AVAILABLE_NOW, snapshot_every=3))
    fresh = S.Landing(spark, out, 3)
    fresh.locate(spark, 7)
    assert [b for b, _ in fresh.since] == [6] and fresh.snap[("total", "2024-01-01")] == 5
    fresh.locate(spark, 6)  # batch 6 replayed: what it may see ends with the snapshot at 5
    assert fresh.since == []
    fresh.locate(spark, 5)  # batch 5 replayed: its own snapshot is not read
    assert [b for b, _ in fresh.since] == [3, 4]


def test_jobs_per_micro_batch_stay_few_and_even(spark):
    from shoplens.streaming.replay import read_replay, write_replay
    d = tempfile.mkdtemp(prefix="run-")
    n = 24
    write_replay(_hourly(spark, n), os.path.join(d, "replay"), 3600)
    q = S.start_blacklist_tables(read_replay(spark, os.path.join(d, "replay")), os.path.join(d, "out"),
                                 os.path.join(d, "ck"), threshold=3, trigger=AVAILABLE_NOW)
    _await(q)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(str(q.runId))
    assert n <= len(jobs) <= 8 * n
    took = [p["durationMs"]["triggerExecution"] for p in q.recentProgress if p["numInputRows"]]
    assert len(took) == n
    assert sorted(took[-8:])[4] <= 2 * sorted(took[4:12])[4]


def test_processing_time_trigger_runs_on(spark):
    d = tempfile.mkdtemp(prefix="run-")
    src = os.path.join(d, "lines")
    os.makedirs(src)

    def put(name, ms):
        with open(os.path.join(d, name), "w") as f:
            f.write(f"{ms} A c 1 5\n")
        os.rename(os.path.join(d, name), os.path.join(src, name))

    put("a.txt", 1704067200000)
    good, _ = S.clicks_from_lines(spark.readStream.text(src))
    q = S.start_blacklist_tables(good, os.path.join(d, "out"), os.path.join(d, "ck"), threshold=20,
                                 trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        put("b.txt", 1704067260000)
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    got = {(r.ads_id, r.minute): r.clicks for r in S.read_last_hour(spark, os.path.join(d, "out")).collect()}
    assert got == {(5, "00:00"): 1, (5, "00:01"): 1}


def test_a_day_of_aggregates_is_written_by_many_tasks(spark):
    from shoplens.streaming.replay import read_replay, write_replay
    d = tempfile.mkdtemp(prefix="run-")
    c = clicks_df(spark, [(i % 3600 + h * 3600, 100 + i, 1 + i % 5) for h in range(2) for i in range(400)])
    write_replay(c, os.path.join(d, "replay"), 3600)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        _await(S.start_blacklist_tables(read_replay(spark, os.path.join(d, "replay")), os.path.join(d, "out"),
                                        os.path.join(d, "ck"), threshold=0, trigger=AVAILABLE_NOW, snapshot_every=2,
                                        rows_per_file=50))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)

    def files(path):
        return sum(f.endswith(".parquet") for f in os.listdir(os.path.join(d, "out", path)))

    for kind in ("count", "minute"):
        assert files(f"log/batch_id=0/kind={kind}/day=2024-01-01") >= 3, kind
    assert files("snap/batch_id=1/kind=count/day=2024-01-01") >= 3
    assert files("snap/batch_id=1/kind=block/day=all") >= 3
    out = os.path.join(d, "out")
    assert _rows(S.read_kept(spark, out), ["event_id"]) == _rows(ads.ads_kept_clicks(c, 3600, 0), ["event_id"])


def test_tasks_of_a_replay_follow_its_micro_batches(spark, monkeypatch):
    from shoplens.streaming import runner
    d = tempfile.mkdtemp(prefix="run-")
    monkeypatch.setattr(runner, "TABLE_ROWS", 10)
    run_ads_pipeline(clicks_df(spark, [(i * 120, i, 1) for i in range(60)]), d, 3600, 20, state_partitions=2)
    with open(os.path.join(d, "checkpoints", "blacklist", "offsets", "0")) as f:
        assert '"spark.sql.shuffle.partitions":"3"' in f.read()  # 30 clicks each
    cores = spark.sparkContext.defaultParallelism
    assert [runner.replay_tasks(spark, d, 2, 2, n) for n in (1, 8, 30, 1000)] == [min(30, 3 * cores), 4, 2, 2]
    assert runner.replay_tasks(spark, d, 0, None, 10) == cores


def test_a_user_costs_one_frame_more_than_its_chunks():
    """The state form by hand: counts and the block of a micro-batch come together."""
    class State:
        hasTimedOut, exists = False, False

        def update(self, value):
            self.exists, self.get = True, value

    def chunk(*ads):
        return pd.DataFrame({"ts": pd.Timestamp("2024-01-01"), "area": "A", "city": "c", "user_id": 7, "ads_id": ads,
                             "event_id": range(len(ads)), "day": "2024-01-01"})

    step, state = S._blacklist_step(1, None), State()
    first = list(step((7,), iter([chunk(1, 1), chunk(2)]), state))
    assert [f["kind"].tolist() for f in first] == [["click"] * 2, ["click"], ["count"] * 2]
    assert sorted(zip(first[2]["ads_id"], first[2]["day"], first[2]["n"])) == [(1, "2024-01-01", 2), (2, "2024-01-01", 1)]
    assert sorted(zip(*state.get[:2])) == [("1|2024-01-01", 2), ("2|2024-01-01", 1)] and not state.get[2]
    second = list(step((7,), iter([chunk(1)]), state))
    assert [f["kind"].tolist() for f in second] == [["click"], ["count", "block"]]
    assert second[1]["n"].tolist() == [1, None] and second[1]["day"].tolist() == ["2024-01-01"] * 2
    assert state.get[:3] == ([], [], True)
    assert list(step((7,), iter([chunk(1)]), state)) == []


def test_clicks_of_a_micro_batch_are_landed_by_the_tasks_that_hold_them(spark):
    """They are not dealt by a shuffle: eight parts in order become four files in order."""
    d = tempfile.mkdtemp(prefix="run-")
    rows = spark.range(0, 800, 1, 8).withColumnRenamed("id", "event_id").withColumn("ts", F.lit(0).cast("timestamp"))
    click = [F.col(n) if n in rows.columns else F.lit(None).cast(t).alias(n) for n, t in S.LOG_FIELDS]
    out = rows.select(*click, F.lit("click").alias("kind"), F.lit("1970-01-01").alias("day"))
    S.Landing(spark, d).land(spark, out, 0, 800)
    files = spark.read.parquet(d + "/log/batch_id=0").groupBy(F.input_file_name().alias("f")).agg(
        F.count(F.lit(1)).alias("n"), (F.max("event_id") - F.min("event_id") + 1).alias("span")).collect()
    assert [(f.n, f.span) for f in files] == [(200, 200)] * S.CLICK_FILES


def test_a_window_of_a_replay_is_read_by_several_tasks(spark):
    from shoplens.streaming.replay import write_replay
    from shoplens.streaming.runner import state_tasks
    d = tempfile.mkdtemp(prefix="run-")
    ids = spark.range(300_000)
    clicks = ids.select(F.timestamp_millis(F.col("id")).alias("ts"), F.lit("A").alias("area"), F.lit("c").alias("city"),
                        F.xxhash64("id").alias("user_id"), (F.col("id") % 3).alias("ads_id"), F.col("id").alias("event_id"))
    assert write_replay(clicks, d, 3600) == 1
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    with state_tasks(spark, 2):
        read = spark.read.parquet(d + "/files/*").groupBy(F.spark_partition_id()).count().collect()
    assert len(read) > 1 and sum(r["count"] for r in read) == 300_000
    assert spark.conf.get("spark.sql.files.openCostInBytes") == old


class ShareState:
    """A state of the pandas form by hand."""
    hasTimedOut, exists = False, False

    def update(self, value):
        self.exists, self.get = True, value


def _share_step_rows(step, state, clicks):
    """(kind, user, ad, event, day, n) of (user, ad, event, day) clicks in chunks of two; None: null."""
    names = ["user_id", "ads_id", "event_id"]
    frames = []
    for at in range(0, len(clicks), 2):
        rows = clicks[at:at + 2]
        ids = {n: [r[i] or 0 for r in rows] for i, n in enumerate(names)}
        nulls = [sum(S.NULL_BIT[n] for n, v in zip(names, r) if v is None) for r in rows]
        frames.append(pd.DataFrame({"share": 0, "us": 5, "area": "A", "city": "c", "day": [r[3] for r in rows], **ids, "nulls": nulls}))
    out = list(step((0,), iter(frames), state))
    return [(r.kind, *(None if r.nulls & S.NULL_BIT[n] else getattr(r, n) for n in names), r.day,
             None if r.nulls & S.NULL_BIT["n"] else r.n) for f in out for r in f.itertuples()]


def test_a_share_of_users_equals_its_users_one_by_one():
    import random
    for seed in range(40):
        rnd = random.Random(seed)
        step, state, counts, blocked = S._share_step(1), ShareState(), {}, {}
        for b in range(8):
            clicks = [(rnd.choice([1, 2, 3, 2**60 + 1, None]), rnd.choice([1, 2, None]), rnd.choice([2**60 + 1, 7, None]),
                       f"2024-01-{rnd.randint(max(1, b - 2), b + 1):02d}") for _ in range(rnd.randint(0, 7))]
            kept = [c for c in clicks if c[0] not in blocked]
            now = {}
            for user, ad, _, day in kept:
                now[user, ad, day] = now.get((user, ad, day), 0) + 1
            over = {user for (user, ad, day) in now if counts.get((user, ad, day), 0) > 1}
            newest = {user: max(day for u, _, day in now if u == user) for user in over}
            expected = ([("click", *c, None) for c in kept] + [("count", u, a, None, d, n) for (u, a, d), n in now.items()]
                        + [("block", u, None, None, d, None) for u, d in newest.items()])
            key = lambda r: tuple(map(str, r))
            assert sorted(_share_step_rows(step, state, clicks), key=key) == sorted(expected, key=key), (seed, b)
            for cell, n in now.items():
                counts[cell] = counts.get(cell, 0) + n
            blocked |= newest
        if state.exists:  # a blocked user's cells are given up, of all days
            days, blocks, out = state.get
            left = {(None if no & 1 else u, None if no & 2 else a, d): n for d, c in zip(days, blocks)
                    for u, a, no, n in S._unblock(c, 4).tolist()}
            assert left == {cell: n for cell, n in counts.items() if cell[0] not in blocked}
            assert {None if no else u for u, no in S._unblock(out, 2).tolist()} == set(blocked)


def test_the_state_form_has_a_state_per_share_not_per_user(spark):
    """Spark's calls cost milliseconds a state: 400 users of a micro-batch made 400."""
    from shoplens.streaming.replay import read_replay, write_replay
    d = tempfile.mkdtemp(prefix="run-")
    rows = [(b * 3600 + u, u, 1 + u % 2) for b in range(3) for u in range(400) if u % 4 or b < 2]
    c = clicks_df(spark, rows)
    write_replay(c, os.path.join(d, "replay"), 3600)
    start = lambda shares: S.start_blacklist(
        read_replay(spark, os.path.join(d, "replay")), os.path.join(d, "out"), os.path.join(d, "ck"), threshold=0,
        trigger=AVAILABLE_NOW, **shares)
    q = start({})
    _await(q)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p.get("stateOperators")]
    assert 0 < max(states) <= S.SHARES < 400
    out = os.path.join(d, "out")
    kept = ads.ads_kept_clicks(c, 3600, 0)
    assert _rows(S.read_kept(spark, out), ["event_id"]) == _rows(kept, ["event_id"])
    assert len(_rows(S.read_blocked(spark, out), ["user_id"])) == 400
    assert {r.n for r in S.read_user_ad_counts(spark, out).collect()} == {2}
    with pytest.raises(RuntimeError, match="shares=128, not 64"):
        start({"shares": 64})
