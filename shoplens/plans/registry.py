"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given tables in ``sf_dir`` whole and returns a lazy
DataFrame; parameters are the fixed job parameters of FIXTURES.md §B.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens import oracle_sql
from shoplens import params as P
from shoplens.operators import keyfilter
from shoplens.operators.topn import bucket_sample
from shoplens.params import Condition
from shoplens.plans import ads, categories, funnel, grains, regions, sessions
from shoplens.schemas import USER_VISIT_ACTION
from shoplens.session import prepare, shared_dir
from shoplens.sources.ads import format_ads_lines, parse_ads_lines
from shoplens.sources.sinks import write_table
from shoplens.sources.tables import ShopTables
from shoplens.streaming import ads_stream as S
from shoplens.streaming import blacklist, sliding, totals
from shoplens.streaming.runner import (read_lines, run_ads_pipeline, run_lines, run_native_blacklist, run_native_sliding,
                                       run_native_totals)

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark: SparkSession, sf_dir: str) -> ShopTables:
    prepare(spark)
    return ShopTables(spark, sf_dir)


# --- Q6 ---------------------------------------------------------------------

def q_area_product_clicks(spark, sf_dir):
    t = _tables(spark, sf_dir)
    cc = regions.city_product_clicks(t.actions(), t.cities(), t.products())
    return regions.area_product_clicks(cc)


def q_city_remark(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return regions.city_remark(regions.city_product_clicks(t.actions(), t.cities(), t.products()))


def q_area_top3_product(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return regions.area_top_products(t.actions(), t.cities(), t.products(), n=3)


def q_area_top3_product_sql(spark, sf_dir):
    """U2: the same as statements, with ``city_remark`` as an SQL function."""
    t = _tables(spark, sf_dir)
    return regions.area_top_products_sql(t.actions(), t.cities(), t.products(), n=3)


# --- Q1-Q5 -------------------------------------------------------------------

CONDITION = Condition(start_date=P.START_DATE, end_date=P.END_DATE, start_age=P.START_AGE,
                      end_age=P.END_AGE, target_page_flow=P.PAGE_FLOW)
TASK_ID = P.TASK_ID


def _filtered(spark, sf_dir, cond: Condition = CONDITION):
    t = _tables(spark, sf_dir)
    return sessions.filter_actions(t.actions(cond.start_date, cond.end_date), t.users(), cond)


def q_filter_actions(spark, sf_dir):
    return _filtered(spark, sf_dir)


def q_session_summary(spark, sf_dir):
    return sessions.session_summary(_filtered(spark, sf_dir))


def q_session_stat(spark, sf_dir):
    return sessions.session_stat(_filtered(spark, sf_dir), CONDITION, TASK_ID)


def q_session_quota(spark, sf_dir):
    return sessions.session_quota(_filtered(spark, sf_dir))


def q_session_sample(spark, sf_dir):
    return sessions.session_sample(_filtered(spark, sf_dir), seed=P.SAMPLE_SEED, task_id=TASK_ID)


def q_session_sample_buckets(spark, sf_dir):
    """W5 from mergeable counts: the same sessions."""
    return sessions.session_sample(_filtered(spark, sf_dir), seed=P.SAMPLE_SEED, task_id=TASK_ID, draw=bucket_sample)


def q_category_action_counts(spark, sf_dir):
    return categories.category_action_counts(_filtered(spark, sf_dir))


def q_category_top10(spark, sf_dir):
    return categories.category_top(_filtered(spark, sf_dir), 10, TASK_ID)


def q_category_session_top10(spark, sf_dir):
    a = _filtered(spark, sf_dir)
    return categories.category_session_top(a, categories.category_top(a, 10), 10, TASK_ID)


def q_page_visits(spark, sf_dir):
    return funnel.page_visits(_filtered(spark, sf_dir), CONDITION.target_page_flow)


def q_page_transitions(spark, sf_dir):
    return funnel.page_transitions(_filtered(spark, sf_dir), CONDITION.target_page_flow)


def q_page_convert_rate(spark, sf_dir):
    return funnel.page_convert_rate(_filtered(spark, sf_dir), CONDITION.target_page_flow, TASK_ID)


def q_action_grains(spark, sf_dir):
    """A3, A8, A12: sessions, categories and flow pages in one pass."""
    return grains.action_grains(_filtered(spark, sf_dir), CONDITION.target_page_flow)


def q_table_overwrite(spark, sf_dir):
    """K6: other rows (the users outside the bounds) are saved to the target
    first; the filtered log then replaces them, date-partitioned, and is read
    back with a date bound that prunes folders."""
    folder = shared_dir(spark, "tables", f"actions-{uuid.uuid4().hex[:8]}")
    others = _filtered(spark, sf_dir, Condition(start_age=CONDITION.end_age + 1))
    write_table(others, folder, partition_by=["date"])
    write_table(_filtered(spark, sf_dir), folder, partition_by=["date"])
    back = spark.read.schema(USER_VISIT_ACTION).parquet(folder)
    return (back.where(F.col("date").between(CONDITION.start_date, CONDITION.end_date))
            .select(*sessions.ACTION_COLUMNS))


# --- Q7-Q10 ------------------------------------------------------------------

def _ads(spark, sf_dir, mod):
    return _tables(spark, sf_dir).ads(mod)


def _kept(spark, sf_dir):
    return ads.ads_kept_clicks(_ads(spark, sf_dir, P.ADS_MOD), P.BATCH_SECONDS, P.THRESHOLD)


KEPT_COLUMNS = ["event_id", "user_id", "ads_id", "area", "city", "day", "ts_ms", "batch"]


def q_ads_parse(spark, sf_dir):
    good, _bad = parse_ads_lines(format_ads_lines(_ads(spark, sf_dir, P.ADS_MOD)))
    return good.select(F.unix_millis("ts").alias("ts_ms"), "area", "city", "user_id", "ads_id")


def q_ads_parse_bad(spark, sf_dir):
    """C19: lines of which most are broken in one of five ways; how many of each."""
    clicks = _ads(spark, sf_dir, P.ADS_MOD)
    kind = F.col("event_id") % 6
    lines = format_ads_lines(clicks, keep=["event_id"]).select(
        F.when(kind == 0, F.col("value"))
        .when(kind == 1, F.substring_index("value", " ", 4))
        .when(kind == 2, F.concat(F.lit("x"), "value"))
        .when(kind == 3, F.concat_ws(" ", F.substring_index("value", " ", 3), F.lit("u1"),
                                     F.substring_index("value", " ", -1)))
        .when(kind == 4, F.concat("value", F.lit("a"))).alias("value"))
    _good, bad = parse_ads_lines(lines)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count("line").alias("n_lines"))


def q_ads_blacklist(spark, sf_dir):
    return ads.ads_blacklist(_ads(spark, sf_dir, P.BL_ADS_MOD), P.BL_BATCH_SECONDS,
                             P.BL_THRESHOLD)


def q_ads_kept_clicks(spark, sf_dir):
    return ads.ads_kept_clicks(_ads(spark, sf_dir, P.BL_ADS_MOD), P.BL_BATCH_SECONDS,
                               P.BL_THRESHOLD).select(*KEPT_COLUMNS)


def q_ads_kept_clicks_filtered(spark, sf_dir):
    """F9, K12: the same rows, most of them past a bitmap filter instead of the join."""
    clicks = _ads(spark, sf_dir, P.BL_ADS_MOD)
    blocked = ads.ads_blacklist(clicks, P.BL_BATCH_SECONDS, P.BL_THRESHOLD)
    shape = keyfilter.Shape.for_keys(P.FILTER_KEYS, P.FILTER_RATE)
    return ads.ads_kept_clicks_filtered(clicks, blocked, shape, P.BL_BATCH_SECONDS).select(*KEPT_COLUMNS)


def q_ads_daily_totals(spark, sf_dir):
    return ads.ads_daily_totals(_kept(spark, sf_dir))


def q_ads_grains(spark, sf_dir):
    """A17, A18: totals per city and per area in one pass."""
    return grains.ads_grains(_kept(spark, sf_dir))


def q_ads_area_top3(spark, sf_dir):
    return ads.ads_area_top(ads.ads_daily_totals(_kept(spark, sf_dir)), 3)


def q_ads_area_top3_json(spark, sf_dir):
    return ads.ads_area_top_json(ads.ads_area_top(ads.ads_daily_totals(_kept(spark, sf_dir)), 3))


def q_ads_last_hour(spark, sf_dir):
    return ads.ads_last_hour(_kept(spark, sf_dir)).drop("_minute")


def q_ads_last_hour_json(spark, sf_dir):
    return ads.ads_last_hour_json(ads.ads_last_hour(_kept(spark, sf_dir)))


def _blocked_kept(spark, sf_dir):
    """Kept clicks under a setting that does block users (as ads_blacklist's)."""
    return ads.ads_kept_clicks(_ads(spark, sf_dir, P.BL_ADS_MOD), P.BL_BATCH_SECONDS, P.BL_THRESHOLD)


def q_ads_daily_totals_blocking(spark, sf_dir):
    return ads.ads_daily_totals(_blocked_kept(spark, sf_dir))


def q_ads_area_top3_blocking(spark, sf_dir):
    return ads.ads_area_top(ads.ads_daily_totals(_blocked_kept(spark, sf_dir)), 3)


def q_ads_area_top3_json_blocking(spark, sf_dir):
    return ads.ads_area_top_json(q_ads_area_top3_blocking(spark, sf_dir))


def q_ads_last_hour_blocking(spark, sf_dir):
    return ads.ads_last_hour(_blocked_kept(spark, sf_dir)).drop("_minute")


def q_ads_last_hour_json_blocking(spark, sf_dir):
    return ads.ads_last_hour_json(ads.ads_last_hour(_blocked_kept(spark, sf_dir)))


# --- stream twins (T1-T10): the replayed clicks through both streaming stages ---

_PIPELINES: dict[tuple, str] = {}


# tasks per shuffle of a replayed micro-batch (at most a few thousand rows)
REPLAY_PARTITIONS = 2


def _pipeline(spark, sf_dir, mod, threshold, stage1="tables"):
    """Run (once per session and parameters) the streaming stages over the
    clicks of ``sf_dir`` replayed in 12-hour micro-batches; returns the
    output folder in the shared checkpoint folder."""
    key = (spark.sparkContext.applicationId, sf_dir, mod, P.STREAM_BATCH_SECONDS, threshold, stage1)
    if key not in _PIPELINES:
        tag = f"{os.path.basename(sf_dir.rstrip('/'))}-m{mod}-t{threshold}-{uuid.uuid4().hex[:8]}"
        folder = shared_dir(spark, "stream", tag)
        _PIPELINES[key] = run_ads_pipeline(_ads(spark, sf_dir, mod), folder,
                                           P.STREAM_BATCH_SECONDS, threshold,
                                           state_partitions=REPLAY_PARTITIONS, stage1=stage1)
    return _PIPELINES[key]


def _bl_out(spark, sf_dir):
    return _pipeline(spark, sf_dir, P.STREAM_BL_ADS_MOD, P.STREAM_BL_THRESHOLD)


def _out(spark, sf_dir):
    # Q8-Q10 twins read the same pipeline: the kept clicks after real blocks
    return _bl_out(spark, sf_dir)


def q_stream_ads_blacklist(spark, sf_dir):
    return S.read_blocked(spark, _bl_out(spark, sf_dir))


def q_stream_state_ads_kept_clicks(spark, sf_dir):
    """The state form of the blacklist (applyInPandasWithState) over the same replay."""
    out = _pipeline(spark, sf_dir, P.STREAM_BL_ADS_MOD, P.STREAM_BL_THRESHOLD, "state")
    return S.read_kept(spark, out).select("event_id", "user_id", "ads_id", "area", "city", "day")


def q_stream_ads_kept_clicks(spark, sf_dir):
    return S.read_kept(spark, _bl_out(spark, sf_dir)).select(
        "event_id", "user_id", "ads_id", "area", "city", "day")


def q_stream_ads_user_counts(spark, sf_dir):
    return S.read_user_ad_counts(spark, _bl_out(spark, sf_dir))


def q_stream_ads_daily_totals(spark, sf_dir):
    return S.read_daily_totals(spark, _out(spark, sf_dir))


def q_stream_ads_area_top3(spark, sf_dir):
    return S.read_area_top(spark, _out(spark, sf_dir))


def q_stream_ads_area_top3_json(spark, sf_dir):
    return S.read_area_top_json(spark, _out(spark, sf_dir))


def q_stream_ads_last_hour(spark, sf_dir):
    return S.read_last_hour(spark, _out(spark, sf_dir)).drop("minute_start")


def q_stream_ads_last_hour_json(spark, sf_dir):
    return S.read_last_hour_json(spark, _out(spark, sf_dir))


# --- the same questions from native state: blacklist cells -> kept clicks -> totals, sliding hour ---

KEPT_FILES = 12  # files of kept clicks in a micro-batch of the later queries


def _native(spark, sf_dir, part="blacklist"):
    """Run (once per application and table) a native streaming query and, before it, the blacklist it reads."""
    key = (spark.sparkContext.applicationId, sf_dir, "native", part)
    if key not in _PIPELINES:
        if part == "blacklist":
            folder = shared_dir(spark, "stream", f"native-{uuid.uuid4().hex[:12]}")
            run_native_blacklist(_ads(spark, sf_dir, P.STREAM_BL_ADS_MOD), folder, P.NATIVE_BATCH_SECONDS,
                                 P.STREAM_BL_THRESHOLD, REPLAY_PARTITIONS)
        else:
            folder = os.path.dirname(_native(spark, sf_dir))
            if part == "totals":
                run_native_totals(spark, folder, P.TOTALS_LATENESS, KEPT_FILES, REPLAY_PARTITIONS)
            else:
                run_native_sliding(spark, folder, P.SLIDE, P.SLIDE_LATENESS, KEPT_FILES, REPLAY_PARTITIONS)
        _PIPELINES[key] = folder
    return os.path.join(_PIPELINES[key], part)


def q_stream_native_blacklist(spark, sf_dir):
    return blacklist.read_blocked(spark, f"{_native(spark, sf_dir)}/out")


def q_stream_native_kept_clicks(spark, sf_dir):
    return blacklist.read_kept(spark, f"{_native(spark, sf_dir)}/out").select(
        "event_id", "user_id", "ads_id", "area", "city", "day")


def q_stream_native_user_counts(spark, sf_dir):
    """K8, K13: the counters, read from the state store."""
    return blacklist.state_counts(spark, f"{_native(spark, sf_dir)}/checkpoint")


def q_stream_native_daily_totals(spark, sf_dir):
    return totals.read_totals(spark, f"{_native(spark, sf_dir, 'totals')}/out")


def q_stream_native_open_totals(spark, sf_dir):
    """K9: the totals of the days still open at the end, read from the state store."""
    return totals.state_totals(spark, f"{_native(spark, sf_dir, 'totals')}/checkpoint")


def q_stream_native_area_top3(spark, sf_dir):
    return totals.read_top(spark, f"{_native(spark, sf_dir, 'totals')}/out")


def q_stream_native_sliding_hour(spark, sf_dir):
    return sliding.read_slides(spark, f"{_native(spark, sf_dir, 'sliding')}/out").select(
        "ads_id", "slide_ms", F.date_format(F.timestamp_millis("minute_ms"), "HH:mm").alias("minute"), "clicks")


LINE_BYTES = 256 << 10  # of ad lines a start of the line stream takes


def q_stream_lines_ads_parse(spark, sf_dir):
    """K3: the clicks as files of ad lines, read by byte offsets, parsed and landed."""
    key = (spark.sparkContext.applicationId, sf_dir, "lines")
    if key not in _PIPELINES:
        folder = shared_dir(spark, "stream", f"lines-{uuid.uuid4().hex[:12]}")
        _PIPELINES[key] = run_lines(format_ads_lines(_ads(spark, sf_dir, P.ADS_MOD)), folder, LINE_BYTES)
    return read_lines(spark, _PIPELINES[key]).where("kind = 'good'").select(
        F.unix_millis("ts").alias("ts_ms"), "area", "city", "user_id", "ads_id")


QUERIES: dict[str, Query] = {
    "filter_actions": q_filter_actions,
    "session_summary": q_session_summary,
    "session_stat": q_session_stat,
    "session_quota": q_session_quota,
    "session_sample": q_session_sample,
    "session_sample_buckets": q_session_sample_buckets,
    "category_action_counts": q_category_action_counts,
    "category_top10": q_category_top10,
    "category_session_top10": q_category_session_top10,
    "page_visits": q_page_visits,
    "page_transitions": q_page_transitions,
    "page_convert_rate": q_page_convert_rate,
    "action_grains": q_action_grains,
    "table_overwrite": q_table_overwrite,
    "area_product_clicks": q_area_product_clicks,
    "city_remark": q_city_remark,
    "area_top3_product": q_area_top3_product,
    "area_top3_product_sql": q_area_top3_product_sql,
    "ads_parse": q_ads_parse,
    "ads_parse_bad": q_ads_parse_bad,
    "ads_blacklist": q_ads_blacklist,
    "ads_kept_clicks": q_ads_kept_clicks,
    "ads_kept_clicks_filtered": q_ads_kept_clicks_filtered,
    "ads_daily_totals": q_ads_daily_totals,
    "ads_grains": q_ads_grains,
    "ads_area_top3": q_ads_area_top3,
    "ads_area_top3_json": q_ads_area_top3_json,
    "ads_last_hour": q_ads_last_hour,
    "ads_last_hour_json": q_ads_last_hour_json,
    "ads_daily_totals_blocking": q_ads_daily_totals_blocking,
    "ads_area_top3_blocking": q_ads_area_top3_blocking,
    "ads_area_top3_json_blocking": q_ads_area_top3_json_blocking,
    "ads_last_hour_blocking": q_ads_last_hour_blocking,
    "ads_last_hour_json_blocking": q_ads_last_hour_json_blocking,
    "stream_ads_blacklist": q_stream_ads_blacklist,
    "stream_ads_kept_clicks": q_stream_ads_kept_clicks,
    "stream_ads_user_counts": q_stream_ads_user_counts,
    "stream_ads_daily_totals": q_stream_ads_daily_totals,
    "stream_ads_area_top3": q_stream_ads_area_top3,
    "stream_ads_area_top3_json": q_stream_ads_area_top3_json,
    "stream_ads_last_hour": q_stream_ads_last_hour,
    "stream_ads_last_hour_json": q_stream_ads_last_hour_json,
    "stream_state_ads_kept_clicks": q_stream_state_ads_kept_clicks,
    "stream_lines_ads_parse": q_stream_lines_ads_parse,
    "stream_native_blacklist": q_stream_native_blacklist,
    "stream_native_kept_clicks": q_stream_native_kept_clicks,
    "stream_native_user_counts": q_stream_native_user_counts,
    "stream_native_daily_totals": q_stream_native_daily_totals,
    "stream_native_open_totals": q_stream_native_open_totals,
    "stream_native_area_top3": q_stream_native_area_top3,
    "stream_native_sliding_hour": q_stream_native_sliding_hour,
}


ORACLE: dict[str, str] = oracle_sql.build_oracle(CONDITION.to_json())
