"""The offline session job (Q1-Q5) and the area job (Q6) end to end.

The filtered visit log feeds five questions. It is written once to the
shared checkpoint folder, partitioned by ``date``, and the questions read it
back: the lineage is cut (a lost executor recomputes from that table, not
from the raw log), later jobs prune by date, and the scan + semi join run
once. Q4 reads Q3's written top-10 instead of recomputing it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from shoplens.params import Condition
from shoplens.plans import categories, funnel, regions, sessions
from shoplens.schemas import USER_VISIT_ACTION
from shoplens.session import shared_dir
from shoplens.sources.sinks import write_table
from shoplens.sources.tables import ShopTables

OFFLINE_OUTPUTS = ("session_stat_info", "random_session_info", "category_top10",
                   "category_top10_session_count", "page_convert_rate")


def land_filtered_actions(spark: SparkSession, tables: ShopTables, cond: Condition,
                          folder: str) -> DataFrame:
    """Write the condition's actions partitioned by date; return the table."""
    acts = sessions.filter_actions(tables.actions(cond.start_date, cond.end_date),
                                   tables.users(), cond)
    write_table(acts, folder, partition_by=["date"])
    return spark.read.schema(USER_VISIT_ACTION).parquet(folder).select(*sessions.ACTION_COLUMNS)


def run_offline(spark: SparkSession, sf_dir: str, cond: Condition, task_id: str | None = None,
                out_dir: str | None = None, sample_total: int = sessions.SAMPLE_SIZE,
                seed: str = "0") -> dict[str, DataFrame]:
    """Run Q1-Q5 for one condition; write each result under ``out_dir`` (a
    folder per output table, one sub-folder per task) when given."""
    task_id = task_id or str(uuid.uuid4())
    tables = ShopTables(spark, sf_dir)
    work = shared_dir(spark, "offline", task_id)
    acts = land_filtered_actions(spark, tables, cond, os.path.join(work, "actions"))

    top_dir = os.path.join(work, "category_top10")
    write_table(categories.category_top(acts, 10, task_id), top_dir)
    top10 = spark.read.parquet(top_dir)

    results = {
        "session_stat_info": sessions.session_stat(acts, cond, task_id),
        "random_session_info": sessions.session_sample(acts, sample_total, seed, task_id),
        "category_top10": top10,
        "category_top10_session_count": categories.category_session_top(acts, top10, 10,
                                                                         task_id),
    }
    if cond.target_page_flow:
        results["page_convert_rate"] = funnel.page_convert_rate(acts, cond.target_page_flow,
                                                                task_id)
    if out_dir:
        for name, df in results.items():
            write_table(df, os.path.join(out_dir, name, f"task_id={task_id}"))
    return results


def run_area_top(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """Q6 over the whole log (no condition)."""
    t = ShopTables(spark, sf_dir)
    return regions.area_top_products(t.actions(), t.cities(), t.products(), n)


ADS_OUTPUTS = ("user_blacklist", "area_city_ads_day_clickcount", "top3_ads_per_day",
               "last_hour_ads_click")


def run_ads_batch(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
                  batch_seconds: int = 5, threshold: int = 20, ads_mod: int = 6,
                  run_id: str | None = None) -> dict[str, DataFrame]:
    """Q7-Q10 over stored clicks (the batch twin of the streaming job).

    The blacklist is written once and joined from there; the kept clicks feed
    three questions, so they are written once too and Q8-Q10 read that table: the click scan and the
    blacklist join run once, and the newest-click subquery of Q10 reads the
    landed table.
    """
    from shoplens.plans import ads
    run_id = run_id or str(uuid.uuid4())
    work = shared_dir(spark, "ads", run_id)
    clicks = ShopTables(spark, sf_dir).ads(ads_mod)
    blacklist = ads.ads_blacklist(clicks, batch_seconds, threshold)
    kept_dir = os.path.join(work, "kept")
    blacklist_dir = os.path.join(work, "blacklist")
    write_table(blacklist, blacklist_dir)
    blacklist = spark.read.schema(blacklist.schema).parquet(blacklist_dir)
    write_table(ads.ads_kept_clicks(clicks, batch_seconds, threshold, blacklist), kept_dir)
    kept = spark.read.parquet(kept_dir)
    totals = ads.ads_daily_totals(kept)
    results = {
        "user_blacklist": blacklist,
        "area_city_ads_day_clickcount": totals,
        "top3_ads_per_day": ads.ads_area_top_json(ads.ads_area_top(totals)),
        "last_hour_ads_click": ads.ads_last_hour_json(ads.ads_last_hour(kept)),
    }
    if out_dir:
        for name, df in results.items():
            write_table(df, os.path.join(out_dir, name, f"run_id={run_id}"))
    return results
