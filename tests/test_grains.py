"""One pass at several grains equals the questions asked one by one."""

from pyspark.sql import functions as F

from rows import action
from shoplens.plans import ads, categories, funnel, grains, sessions
from shoplens.plans import registry as R
from test_plans import _scans

SF = "/root/testdata/sf0.001"
FLOW = (1, 2, 3, 2)


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_finished_questions_equal_the_single_ones(spark):
    acts = R._filtered(spark, SF)
    g = grains.action_grains(acts, R.CONDITION.target_page_flow).cache()
    assert rows(grains.session_stat(g, R.CONDITION, "t")) == rows(sessions.session_stat(acts, R.CONDITION, "t"))
    assert rows(grains.category_top(g, 10, "t")) == rows(categories.category_top(acts, 10, "t"))
    assert rows(grains.page_visits(g)) == rows(funnel.page_visits(acts, R.CONDITION.target_page_flow))
    g.unpersist()


def test_edge_rows(spark, actions_df):
    acts = actions_df([
        action("s1", "2024-01-01 00:00:00", 1, ccat=4), action("s1", "2024-01-01 00:00:09", 2, ocats="4,5,,"),
        action("s1", "bad time", 9, pcats="7"), action("s2", "bad time", 3, ocats="", pcats="4,4"),
        action("s3", "2024-01-01 01:00:00", None, kw="x")])
    g = grains.action_grains(acts, FLOW)
    assert rows(grains.session_stat(g)) == rows(sessions.session_stat(acts))
    assert rows(grains.category_top(g)) == rows(categories.category_top(acts))
    assert rows(grains.page_visits(g)) == rows(funnel.page_visits(acts, FLOW))
    assert rows(grains.session_stat(g.limit(0))) == rows(sessions.session_stat(acts.limit(0)))


def test_the_log_is_scanned_and_shuffled_once(spark):
    n, tree = _scans(R.QUERIES["action_grains"](spark, SF), "events")
    assert n == 2, tree  # the log and the users
    n, tree = _scans(grains.ads_grains(R._tables(spark, SF).ads(6)), "events")
    assert n == 3 and tree.count("Expand") == 1, tree  # clicks, nations, regions


def test_ads_grains_equal_totals_and_top(spark):
    c = R._tables(spark, SF).ads(6).withColumn("area", F.when(F.col("area") != "ASIA", F.col("area")))
    g = grains.ads_grains(c)
    assert rows(grains.daily_totals(g)) == rows(ads.ads_daily_totals(c))
    assert rows(grains.area_top(g)) == rows(ads.ads_area_top(ads.ads_daily_totals(c)))
