"""Several questions from one pass: an action or a click enters one aggregation at every grain.

``action_grains`` gives, from one scan of the filtered log and one shuffle of
partial aggregates, the rows that Q1 (sessions), Q3 (categories and actions) and
the denominators of Q5 (pages) are made of; ``session_stat``, ``category_top``
and ``page_visits`` here finish them. ``ads_grains`` counts kept clicks per city
and per area (Q8, Q9) by grouping sets. Store the grains (they are far smaller
than the log) and finish each question from the stored table: the log is then
read once, whatever the number of questions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.params import Condition
from shoplens.plans import ads, categories, sessions

GRAIN_SCHEMA = "grain string, key string, action string, n bigint, first_ms bigint, last_ms bigint"


def action_grains(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """grain, key, action, n, first_ms, last_ms.

    ``session``: a session's actions and the first and last time (milliseconds);
    ``category``: a category's items per action; ``page``: visits of the pages a
    step of the flow starts from."""
    ids, action = categories.items_of_action()
    starts = sorted({int(p) for p in flow[:-1]})
    facet = "array<struct<grain:string,key:string,action:string,ms:bigint>>"

    def one(grain: str, key, act, ms):
        return F.struct(F.lit(grain).alias("grain"), key.alias("key"), act.alias("action"), ms.alias("ms"))

    none, nothing = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    # the lists and the time are worked out before the facets, once per action
    a = actions.select("session_id", F.col("page_id").isin(starts).alias("start"), F.col("page_id").cast("string").alias("page"),
                       sessions.time_ms("action_time").alias("ms"), ids.alias("ids"), action.alias("act"))
    session = F.array(one("session", F.col("session_id"), none, F.col("ms"))).cast(facet)
    page = F.when(F.col("start"), F.array(one("page", F.col("page"), none, nothing)).cast(facet)).otherwise(F.array().cast(facet))
    items = F.transform(F.filter(F.coalesce("ids", F.array().cast("array<string>")), lambda x: x.isNotNull()),
                        lambda x: one("category", x, F.col("act"), nothing)).cast(facet)
    return (a.select(F.inline(F.concat(session, page, items))).groupBy("grain", "key", "action")
            .agg(F.count(F.lit(1)).alias("n"), F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms")))


def session_stat(grains: DataFrame, cond: Condition | None = None, task_id: str | None = None) -> DataFrame:
    """Q1 from the session grain."""
    bounds = grains.where("grain = 'session'").select(
        F.col("n").alias("step_length"), (F.col("last_ms") - F.col("first_ms")).alias("visit_length"))
    return sessions.stat_of_bounds(bounds, cond, task_id)


def category_top(grains: DataFrame, n: int = 10, task_id: str | None = None) -> DataFrame:
    """Q3 from the category grain."""
    counts = grains.where("grain = 'category'").groupBy(F.col("key").alias("category_id")).agg(
        *[F.coalesce(F.sum(F.when(F.col("action") == a, F.col("n"))), F.lit(0)).alias(f"{a}_count")
          for a in categories.ACTIONS])
    return categories.top_of_counts(counts, n, task_id)


def page_visits(grains: DataFrame) -> DataFrame:
    """The denominators of Q5 from the page grain."""
    return grains.where("grain = 'page'").select(F.col("key").cast("bigint").alias("page_id"), F.col("n").alias("visit_count"))


def ads_grains(kept: DataFrame) -> DataFrame:
    """day, area, city, ads_id, by_city, clicks: per city, and (by_city false, city null) per area."""
    if "day" not in kept.columns:
        kept = kept.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return kept.sparkSession.sql("""
        SELECT day, area, city, ads_id, grouping(city) = 0 AS by_city, count(*) AS clicks
        FROM {kept} GROUP BY day, area, city, ads_id
        GROUPING SETS ((day, area, city, ads_id), (day, area, ads_id))""", kept=kept)


def daily_totals(grains: DataFrame) -> DataFrame:
    """Q8 from the city grain."""
    return grains.where("by_city").select("day", "area", "city", "ads_id", "clicks")


def area_top(grains: DataFrame, n: int = ads.TOP_ADS) -> DataFrame:
    """Q9 from the area grain, whose sums are done."""
    return ads.top_of_areas(grains.where("not by_city").select("day", "area", "ads_id", "clicks"), n)
