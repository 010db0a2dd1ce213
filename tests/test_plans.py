"""Plan shape: the properties the design relies on at scale, read from .explain()."""

import contextlib
import io

from pyspark.sql import functions as F
from pyspark.sql import Window

import __spark_entry__ as E
from shoplens.operators.sequence import ordered_concat, successor_pairs
from shoplens.plans import registry as R

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_n_uses_window_group_limit(spark):
    for name in ["area_top3_product", "category_session_top10", "ads_area_top3"]:
        p = plan(E.queries()[name](spark, SF))
        assert "WindowGroupLimit" in p, name


def test_sample_limits_each_hour_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(E.queries()["session_sample"](spark, SF))


def test_date_bounds_reach_the_scan(spark):
    p = plan(E.queries()["filter_actions"](spark, SF))
    assert "GreaterThanOrEqual(ts," in p and "LessThan(ts," in p


def test_area_clicks_aggregated_before_the_joins(spark):
    p = plan(E.queries()["area_top3_product"](spark, SF))
    # the first aggregate is keyed by (city_id, click_product_id): that key
    # only exists before the city and product joins
    nodes = p.split("\n\n")
    assert any("Keys [2]: [city_id" in n and "partial_count(1)" in n for n in nodes)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,props:string>" in p


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_building_a_batch_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name in [q for q in R.QUERIES if not q.startswith("stream_") and q != "table_overwrite"]:
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        R.QUERIES[name](spark, SF)
        assert tracker.getJobIdsForGroup(f"build-{name}") == [], name
    spark.sparkContext.setJobGroup("tests", "tests")


def _scans(df, table):
    """Scans of a table in the plan that ran (an exchange that is used again is read once)."""
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    tree = final.split("\n\n\n")[0]
    return sum(line.count("Scan parquet") for line in tree.splitlines()), tree


def test_log_is_scanned_once_for_the_conversion_rate(spark):
    n, tree = _scans(R.QUERIES["page_convert_rate"](spark, SF), "events")
    assert n == 2, tree  # the log and the users


def _hot(spark):
    """One session with 3000 actions over 50 minutes beside 200 small ones."""
    rows = [("hot", f"2024-01-01 10:{i // 60:02d}:{i % 60:02d}", i % 7, i) for i in range(3000)]
    rows += [(f"s{j}", "2024-01-01 11:00:00", j % 5, 10000 + j) for j in range(200)]
    df = spark.createDataFrame(rows, "session_id string, action_time string, page_id long, "
                                     "event_id long")
    return df.withColumn("b", F.substring("action_time", 1, 16))


def test_hot_session_pairs_equal_plain_lead(spark):
    df = _hot(spark)
    got = successor_pairs(df, ["session_id"], "b", ["action_time", "event_id"], "page_id", "nxt")
    w = Window.partitionBy("session_id").orderBy("action_time", "event_id")
    want = df.withColumn("nxt", F.lead("page_id").over(w))
    cols = ["session_id", "event_id", "nxt"]
    assert _rows(got.select(cols)) == _rows(want.select(cols))


def test_hot_session_concat_equals_plain_order(spark):
    df = _hot(spark)
    got = ordered_concat(df, ["session_id"], "b", ["action_time", "event_id"],
                         {"pages": F.col("page_id").cast("string")},
                         extra={"n": (F.count(F.lit(1)), F.sum)})
    r = got.where(F.col("session_id") == "hot").first()
    assert r.n == 3000
    assert r.pages == ",".join(str(i % 7) for i in range(3000))


def test_a_line_is_split_once(spark):
    for name in ["ads_parse", "ads_parse_bad"]:
        p = plan(R.QUERIES[name](spark, SF))
        # one split for the parser in each generated row; the format step has none
        assert p.count("split(") == 1, (name, p.count("split("))
