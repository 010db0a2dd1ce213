from pyspark.sql import functions as F

from rows import action
from shoplens.operators.sequence import successor_pairs
from shoplens.plans import funnel


def _rates(df, flow):
    return {r.page_jump: r.rate for r in funnel.page_convert_rate(df, flow).collect()}


def test_step_that_never_occurs_has_no_row(actions_df):
    rows = [action("a", "2024-01-01 00:00:00", page=1, eid=1),
            action("a", "2024-01-01 00:00:05", page=2, eid=2),
            action("b", "2024-01-01 00:00:00", page=1, eid=3)]
    assert _rates(actions_df(rows), (1, 2, 9)) == {"1-2": 50.0}


def test_time_ties_ordered_by_event_id(actions_df):
    t = "2024-01-01 00:00:00"
    rows = [action("a", t, page=2, eid=2), action("a", t, page=1, eid=1)]
    assert _rates(actions_df(rows), (1, 2)) == {"1-2": 100.0}
    rows = [action("a", t, page=2, eid=1), action("a", t, page=1, eid=2)]
    assert _rates(actions_df(rows), (1, 2)) == {}


def test_pairs_cross_bucket_borders(actions_df, spark):
    # a session over several minutes: the pair across a minute border counts
    rows = [action("a", "2024-01-01 00:00:59", page=1, eid=1),
            action("a", "2024-01-01 00:05:00", page=2, eid=2),
            action("a", "2024-01-01 00:05:01", page=3, eid=3)]
    assert _rates(actions_df(rows), (1, 2, 3)) == {"1-2": 100.0, "2-3": 100.0}


def test_successor_pairs_equal_plain_lead(spark):
    from pyspark.sql import Window
    from shoplens.sources.tables import ShopTables
    a = ShopTables(spark, "/root/testdata/sf0.01").actions().select(
        "session_id", "page_id", "action_time", "event_id",
        F.substring("action_time", 1, 15).alias("b"))  # 10-minute buckets
    got = successor_pairs(a, ["session_id"], "b", ["action_time", "event_id"], "page_id", "nxt")
    w = Window.partitionBy("session_id").orderBy("action_time", "event_id")
    want = a.withColumn("nxt", F.lead("page_id").over(w))
    cols = ["session_id", "event_id", "page_id", "nxt"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert got.count() == want.count()


def test_successor_pairs_with_null_values(spark):
    rows = [("s", "m1", 1, 3), ("s", "m1", 2, None), ("s", "m1", 3, 5), ("s", "m2", 4, 7)]
    df = spark.createDataFrame(rows, "g string, b string, o long, v long")
    got = {r.o: r.nxt for r in successor_pairs(df, ["g"], "b", ["o"], "v", "nxt").collect()}
    assert got == {1: None, 2: 5, 3: 7, 4: None}
