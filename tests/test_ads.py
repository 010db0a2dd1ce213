import datetime as dt

from pyspark.sql import functions as F

from shoplens.plans import ads
from shoplens.sources.ads import format_ads_lines, parse_ads_lines
from shoplens.sources.tables import ShopTables, ads_log

CLICKS = "ts timestamp, area string, city string, user_id long, ads_id long, event_id long"
T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def clicks_df(spark, rows):
    """rows: (seconds after T0, user, ad)."""
    return spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), "A", "c", u, a, i) for i, (s, u, a) in enumerate(rows)],
        CLICKS)


def test_parse_lines(spark):
    lines = spark.createDataFrame([("1704067200000 A c 3 5",), ("1704067200000 A c 3",),
                                   ("1704067200000 A c 3 5 extra",), ("x A c 3 5",), (None,)],
                                  "value string")
    good, bad = parse_ads_lines(lines)
    g = good.collect()
    assert [(r.area, r.city, r.user_id, r.ads_id) for r in g] == [("A", "c", 3, 5)] * 2
    assert sorted(r.reason for r in bad.collect()) == ["fewer than 5 fields", "null line",
                                                       "time is not an integer"]


def test_format_then_parse_round_trip(spark):
    t = ShopTables(spark, "/root/testdata/sf0.001")
    a = t.ads()
    good, bad = parse_ads_lines(format_ads_lines(a))
    assert bad.count() == 0 and good.count() == a.count()
    assert good.where(F.col("area").contains(" ")).count() == 0  # spaces became '_'


def _kept_ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_blacklist_edge_rows(spark):
    h = 3600
    rows = [(i, 1, 1) for i in range(21)] + [(h, 1, 1), (2 * h, 1, 1)]          # user 1
    rows += [(i, 2, 1) for i in range(20)] + [(h, 2, 1), (2 * h, 2, 1), (3 * h, 2, 1)]  # user 2
    rows += [(i, 3, 1) for i in range(21)] + [(h, 3, 1), (2 * h, 3, 2), (90000, 3, 1)]  # user 3
    c = clicks_df(spark, rows)
    first = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) // h
    bl = {r.user_id: r.blocked_batch - first for r in ads.ads_blacklist(c, h, 20).collect()}
    assert bl == {1: 1, 2: 2, 3: 1}
    kept = ads.ads_kept_clicks(c, h, 20).select("user_id", "ts_ms").collect()
    last = {}
    for r in kept:
        last[r.user_id] = max(last.get(r.user_id, 0), r.ts_ms)
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert last[1] == base + h * 1000          # the click of batch 2 kept, batch 3 dropped
    assert last[2] == base + 2 * h * 1000      # blocked in batch 3, batch 4 dropped
    assert last[3] == base + h * 1000          # other ad and next day dropped too


def simulate(rows, batch_seconds, threshold):
    """Sequential micro-batch simulation of the blacklist (the reference's loop)."""
    batches = {}
    for r in rows:
        batches.setdefault(r.ts_ms // (batch_seconds * 1000), []).append(r)
    blocked, totals, kept = set(), {}, []
    for b in sorted(batches):
        live = [r for r in batches[b] if r.user_id not in blocked]
        kept += [r.event_id for r in live]
        counts = {}
        for r in live:
            k = (r.user_id, r.ads_id, r.day)
            counts[k] = counts.get(k, 0) + 1
        for k, n in counts.items():
            if totals.get(k, 0) > threshold:
                blocked.add(k[0])
            totals[k] = totals.get(k, 0) + n
    return sorted(kept), blocked


def test_closed_form_equals_simulation(spark):
    c = ShopTables(spark, "/root/testdata/sf0.01").ads(2)
    rows = ads.with_labels(c).select("ts_ms", "user_id", "ads_id", "day", "event_id").collect()
    for batch_seconds, threshold in [(3600, 2), (21600, 1), (3600, 0)]:
        want_kept, want_blocked = simulate(rows, batch_seconds, threshold)
        got = ads.ads_kept_clicks(c, batch_seconds, threshold)
        assert _kept_ids(got) == want_kept
        bl = {r.user_id for r in ads.ads_blacklist(c, batch_seconds, threshold).collect()}
        assert bl == want_blocked


def test_totals_top_and_last_hour(spark):
    rows = [(0, 1, 1), (1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 1, 3), (5, 1, 3), (6, 1, 4),
            (3600 * 5, 1, 1)]
    c = clicks_df(spark, rows)
    kept = ads.ads_kept_clicks(c)
    top = ads.ads_area_top(ads.ads_daily_totals(kept), 3).orderBy("rank").collect()
    assert [(r.ads_id, r.clicks, r.rank) for r in top] == [(1, 3, 1), (3, 3, 2), (2, 1, 3)]
    j = ads.ads_area_top_json(ads.ads_area_top(ads.ads_daily_totals(kept), 3)).first()
    assert j.top_ads == '[{"1":3},{"3":3},{"2":1}]'
    lh = ads.ads_last_hour(kept).collect()
    assert [(r.ads_id, r.minute, r.clicks) for r in lh] == [(1, "05:00", 1)]


def test_the_click_stream_parses_an_event_once_and_drops_clicks_without_a_city(spark):
    day = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(1, day, 3, '{"k": 4}'), (2, day, 3, '{"k": 5}'), (3, day, 3, "{}"), (4, day, None, '{"k": 4}'), (5, day, 3, None)],
        "event_id bigint, ts timestamp_ntz, user_id bigint, props string")
    cities = spark.createDataFrame([(7, "x", "A"), (7, "y", "A"), (0, "z", "B"), (None, "n", "B")],
                                   "city_id bigint, city_name string, area string")
    got = ads_log(events, cities, 2)
    assert sorted((r.event_id, r.city, r.ads_id) for r in got.collect()) == [(1, "x", 1), (1, "y", 1)]
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("get_json_object" in x for x in lines if "Filter" in x or "Join" in x)
