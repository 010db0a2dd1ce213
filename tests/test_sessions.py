import json

from pyspark.sql import functions as F

from rows import action
from shoplens.params import Condition
from shoplens.plans import sessions


def test_bounds_le_is_inclusive(actions_df):
    rows = [
        # 10 s, 5 steps -> le / le
        *[action("a", f"2024-01-01 00:00:{s:02d}", eid=i) for i, s in enumerate([0, 2, 4, 6, 10])],
        # 11 s, 6 steps -> gt / gt
        *[action("b", f"2024-01-01 00:00:{s:02d}", eid=10 + i)
          for i, s in enumerate([0, 1, 2, 3, 4, 11])],
    ]
    r = sessions.session_stat(actions_df(rows)).first()
    assert r.session_count == 2
    assert (r.visit_length_gt_10_ratio, r.visit_length_le_10_ratio) == (50.0, 50.0)
    assert (r.step_length_gt_5_ratio, r.step_length_le_5_ratio) == (50.0, 50.0)


def test_empty_bucket_and_empty_input(actions_df, spark):
    short = [action("a", "2024-01-01 00:00:00"), action("a", "2024-01-01 00:00:01", eid=1)]
    r = sessions.session_stat(actions_df(short)).first()
    assert r.visit_length_gt_10_ratio == 0.0 and r.visit_length_le_10_ratio == 100.0
    r = sessions.session_stat(actions_df([])).first()
    assert r.session_count == 0 and r.visit_length_gt_10_ratio is None


def test_filter_cuts_session_at_date_bound(actions_df, spark):
    rows = [action("a", "2024-01-02 23:59:50", eid=1), action("a", "2024-01-03 00:00:30", eid=2)]
    users = spark.createDataFrame([(1, "u", "u", 30, "X", "M")],
                                  "user_id long, username string, name string, age int, "
                                  "professional string, gender string")
    cond = Condition(end_date="2024-01-02", start_age=20, end_age=50, professionals=("X",))
    f = sessions.filter_actions(actions_df(rows), users, cond)
    b = sessions.session_bounds(f).first()
    assert b.step_length == 1 and b.visit_length == 0  # only the inside part counts
    assert sessions.filter_actions(actions_df(rows), users,
                                   Condition(professionals=("Y",))).count() == 0


def test_summary_lists_in_time_order_with_ties(actions_df):
    t = "2024-01-01 00:00:00"
    rows = [
        action("a", t, kw="b", eid=2), action("a", t, kw="a", eid=1),  # same second: event id
        action("a", "2024-01-01 00:01:00", cprod=7, ccat=3, eid=3),
        action("a", "2024-01-01 00:02:00", oprods="", ocats="", eid=4),  # '' order still listed
        action("a", "2024-01-01 00:03:00", oprods="1,2", ocats="4,5", eid=5),
        action("a", "2024-01-01 00:04:00", pprods="9", pcats="6", eid=6),
    ]
    r = sessions.session_summary(actions_df(rows)).first()
    assert r.search_keywords == "a,b"
    assert r.click_product_ids == "7"
    assert r.order_product_ids == ",1,2"
    assert r.pay_product_ids == "9"
    assert r.start_time == t and r.step_length == 6 and r.visit_length == 240000


def test_quota_larger_than_group_ends(actions_df):
    rows = [action(f"s{i}", "2024-01-01 10:00:00", eid=i) for i in range(3)]
    s = sessions.session_sample(actions_df(rows), total=1000)
    assert s.count() == 3
    q = sessions.session_quota(actions_df(rows), total=1000).first()
    assert (q.session_count, q.quota, q.taken) == (3, 1000, 3)


def test_sample_is_proportional_and_repeatable(spark):
    from shoplens.sources.tables import ShopTables
    t = ShopTables(spark, "/root/testdata/sf0.01")
    acts = t.actions()
    s1 = sessions.session_sample(acts, total=100, seed="7")
    s2 = sessions.session_sample(acts, total=100, seed="7")
    assert sorted(r[0] for r in s1.select("session_id").collect()) == \
        sorted(r[0] for r in s2.select("session_id").collect())
    q = sessions.session_quota(acts, total=100)
    got = (s1.groupBy(F.substring("start_time", 1, 13).alias("day_hour")).count()
           .join(q, "day_hour").collect())
    assert all(r["count"] == r["taken"] for r in got)
    assert abs(s1.count() - 100) <= q.count()


def test_condition_from_json():
    c = Condition.from_json(json.dumps({"startDate": "2018-11-01", "endDate": "2018-12-28",
                                        "startAge": "20", "endAge": "50",
                                        "professionals": "'a','b'", "targetPageFlow": "1,2,3"}))
    assert c.start_age == 20 and c.professionals == ("a", "b") and c.target_page_flow == (1, 2, 3)


def test_unparsed_times_are_counted(spark, actions_df):
    rows = [action("a", "2024-01-01 00:00:00", eid=1), action("a", "not a time", eid=2),
            action("b", "not a time", eid=3), action("c", "2024-01-01 00:00:05", eid=4)]
    assert tuple(sessions.unparsed_times(actions_df(rows)).first()) == (2, 1)
    assert tuple(sessions.unparsed_times(actions_df([])).first()) == (0, 0)
