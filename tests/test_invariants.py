"""Invariants over the given sf0.01 tables and a property test of the blacklist."""


from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoplens.plans import ads, registry as R, sessions
from test_ads import clicks_df, simulate

SF = "/root/testdata/sf0.01"


def test_ratio_pairs_add_to_100(spark):
    r = R.q_session_stat(spark, SF).first()
    assert abs(r.visit_length_gt_10_ratio + r.visit_length_le_10_ratio - 100) <= 0.1
    assert abs(r.step_length_gt_5_ratio + r.step_length_le_5_ratio - 100) <= 0.1


def test_session_top_categories_are_top_categories(spark):
    top = {r.category_id for r in R.q_category_top10(spark, SF).collect()}
    per = {r.category_id for r in R.q_category_session_top10(spark, SF).collect()}
    assert per <= top and len(top) == 10


def test_area_top_totals_within_daily_totals(spark):
    tot = R.q_ads_daily_totals(spark, SF)
    per_area = tot.groupBy("day", "area", "ads_id").agg(F.sum("clicks").alias("all"))
    top = R.q_ads_area_top3(spark, SF).join(per_area, ["day", "area", "ads_id"])
    assert top.where(F.col("clicks") > F.col("all")).count() == 0
    assert top.where(F.col("clicks") != F.col("all")).count() == 0  # sums of the same totals


def test_session_sample_within_quota(spark):
    acts = R._filtered(spark, SF)
    s = sessions.session_sample(acts)
    q = sessions.session_quota(acts)
    per = s.groupBy(F.substring("start_time", 1, 13).alias("day_hour")).count()
    bad = per.join(q, "day_hour").where(F.col("count") > F.col("taken"))
    assert bad.count() == 0


clicks = st.lists(st.tuples(st.integers(0, 4 * 3600 - 1),  # seconds: four 1-hour batches
                            st.integers(1, 3),                # user
                            st.integers(1, 2)),               # ad
                  min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=clicks, threshold=st.integers(0, 3))
def test_closed_form_blacklist_property(spark, rows, threshold):
    c = clicks_df(spark, rows)
    labelled = ads.with_labels(c, 3600).select("ts_ms", "user_id", "ads_id", "day",
                                               "event_id").collect()
    want_kept, want_blocked = simulate(labelled, 3600, threshold)
    got = sorted(r.event_id for r in ads.ads_kept_clicks(c, 3600, threshold)
                 .select("event_id").collect())
    assert got == want_kept
    assert {r.user_id for r in ads.ads_blacklist(c, 3600, threshold).collect()} == want_blocked
