"""Q1 session statistics and Q2 proportional session sample (plus the filter).

- ``filter_actions``: the condition's bounds on the visit log; the user
  bounds become a semi join with the filtered users (broadcast or shuffled as
  file statistics and AQE say; AQE splits the shuffle when one user is hot).
- ``session_bounds``: one row per session from plain aggregates (min / max
  time, count): partial aggregation makes a hot session one row per task.
- ``session_stat``: one row of ratios over the session bounds.
- ``session_summary``: bounds plus the four ordered value lists, built with
  ``ordered_concat`` (per minute of the session first, then per session).
- ``session_sample``: the draw uses only the bounds; lists are built for the
  drawn sessions alone (at most ``total`` plus rounding, broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import action_kind, pct1, time_ms
from shoplens.operators.sequence import ordered_concat
from shoplens.operators.topn import proportional_sample
from shoplens.params import Condition

# Fixed values of the reference's session buckets.
VISIT_LENGTH_LIMIT_MS = 10_000
STEP_LENGTH_LIMIT = 5
SAMPLE_SIZE = 1000

ACTION_COLUMNS = ["date", "user_id", "session_id", "page_id", "action_time", "search_keyword",
                  "click_category_id", "click_product_id", "order_category_ids",
                  "order_product_ids", "pay_category_ids", "pay_product_ids", "city_id",
                  "event_id"]


def filter_actions(actions: DataFrame, users: DataFrame, cond: Condition) -> DataFrame:
    """Actions of known users inside the condition's bounds (all inclusive).

    ``user_info`` is keyed by ``user_id``, so the reference's inner join with
    it equals a semi join; an action of an unknown user is dropped.
    """
    a = actions
    if cond.start_date is not None:
        a = a.where(F.col("date") >= F.lit(cond.start_date))
    if cond.end_date is not None:
        a = a.where(F.col("date") <= F.lit(cond.end_date))
    u = users
    if cond.start_age is not None:
        u = u.where(F.col("age") >= F.lit(cond.start_age))
    if cond.end_age is not None:
        u = u.where(F.col("age") <= F.lit(cond.end_age))
    if cond.professionals:
        u = u.where(F.col("professional").isin(list(cond.professionals)))
    return a.join(u.select("user_id"), "user_id", "left_semi").select(*ACTION_COLUMNS)


def _ms_to_text(ms) -> F.Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")


def session_bounds(actions: DataFrame) -> DataFrame:
    """session_id, start_time, step_length, visit_length (ms, second resolution).

    The bounds are aggregated as epoch milliseconds (LONG) so the aggregation
    stays a hash aggregate (a min / max over strings would sort every map
    task's input); the start is formatted back afterwards.
    """
    ms = time_ms("action_time")
    agg = actions.groupBy("session_id").agg(
        F.min(ms).alias("_start"), F.max(ms).alias("_end"), F.count(F.lit(1)).alias("step_length"))
    return agg.select("session_id", _ms_to_text("_start").alias("start_time"), "step_length",
                      (F.col("_end") - F.col("_start")).alias("visit_length"))


def unparsed_times(actions: DataFrame) -> DataFrame:
    """One row: actions whose time cannot be parsed, and sessions in which none
    can. Such a session has no length, so it counts in ``session_count`` but in
    neither of Q1's length buckets."""
    bad = F.max(time_ms("action_time")).isNull()
    per = actions.groupBy("session_id").agg(
        F.count(F.when(time_ms("action_time").isNull(), 1)).alias("n"), bad.alias("lost"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unparsed_actions"),
                   F.count(F.when(F.col("lost"), 1)).alias("sessions_without_time"))


def session_stat(actions: DataFrame, cond: Condition | None = None,
                 task_id: str | None = None) -> DataFrame:
    """One row: session count and the four ratios in percent, one decimal.

    A session longer than 10 s / with more than 5 steps is "gt"; exactly 10 s
    and exactly 5 steps are "le". An empty bucket gives 0.0; no session at
    all gives null ratios.
    """
    return stat_of_bounds(session_bounds(actions), cond, task_id)


def stat_of_bounds(b: DataFrame, cond: Condition | None = None, task_id: str | None = None) -> DataFrame:
    """``session_stat`` of step_length, visit_length rows, one per session."""
    long_ = F.col("visit_length") > VISIT_LENGTH_LIMIT_MS
    many = F.col("step_length") > STEP_LENGTH_LIMIT
    agg = b.agg(F.count(F.lit(1)).alias("n"),
                F.count(F.when(long_, 1)).alias("vgt"), F.count(F.when(~long_, 1)).alias("vle"),
                F.count(F.when(many, 1)).alias("sgt"), F.count(F.when(~many, 1)).alias("sle"))
    cols = []
    if task_id is not None:
        cols.append(F.lit(task_id).alias("task_id"))
    if cond is not None:
        cols.append(F.lit(cond.to_json()).alias("conditions"))
    return agg.select(*cols, F.col("n").alias("session_count"),
                      pct1("vgt", "n").alias("visit_length_gt_10_ratio"),
                      pct1("vle", "n").alias("visit_length_le_10_ratio"),
                      pct1("sgt", "n").alias("step_length_gt_5_ratio"),
                      pct1("sle", "n").alias("step_length_le_5_ratio"))


def _lists(actions: DataFrame, with_bounds: bool = False) -> DataFrame:
    """Per session the four ordered lists (and, if asked, the bounds in the
    same two aggregation passes)."""
    kind = action_kind()
    a = actions.select("session_id", "action_time", "event_id",
                       F.substring("action_time", 1, 16).alias("_minute"),
                       kind.alias("_kind"), "search_keyword", "click_product_id",
                       "order_product_ids", "pay_product_ids")
    k = F.col("_kind")
    return ordered_concat(
        a, ["session_id"], "_minute", ["action_time", "event_id"],
        {"search_keywords": F.when(k == "search", F.col("search_keyword")),
         "click_product_ids": F.when(k == "click", F.col("click_product_id").cast("string")),
         "order_product_ids": F.when(k == "order", F.col("order_product_ids")),
         "pay_product_ids": F.when(k == "pay", F.col("pay_product_ids"))},
        extra=({"_start": (F.min(time_ms("action_time")), F.min),
                "_end": (F.max(time_ms("action_time")), F.max),
                "step_length": (F.count(F.lit(1)), F.sum)} if with_bounds else None))


SUMMARY_COLUMNS = ["session_id", "start_time", "step_length", "visit_length", "search_keywords",
                   "click_product_ids", "order_product_ids", "pay_product_ids"]


def session_summary(actions: DataFrame) -> DataFrame:
    """Per session: bounds and the comma-joined search words, clicked products,
    order lists and pay lists, in time order (event id breaks ties).

    One read and two aggregation passes: per (session, minute), then per
    session, with the bounds merged along the lists."""
    return _summary(actions)


def _summary(actions: DataFrame) -> DataFrame:
    s = _lists(actions, with_bounds=True)
    return s.select("session_id", _ms_to_text("_start").alias("start_time"), "step_length",
                    (F.col("_end") - F.col("_start")).alias("visit_length"),
                    *SUMMARY_COLUMNS[4:])


def session_quota(actions: DataFrame, total: int = SAMPLE_SIZE) -> DataFrame:
    """Per start hour (``yyyy-MM-dd HH``): sessions and the sample quota
    ``round(n_hour / n_all * total)``, and what is taken: ``least(quota, n)``."""
    b = session_bounds(actions).select(F.substring("start_time", 1, 13).alias("day_hour"))
    per = b.groupBy("day_hour").agg(F.count(F.lit(1)).alias("session_count"))
    n_all = per.select(F.sum("session_count")).scalar()
    quota = F.round(F.try_divide(F.col("session_count").cast("double"), n_all.cast("double"))
                    * F.lit(float(total))).cast("bigint")
    return per.select("day_hour", "session_count", quota.alias("quota"),
                      F.least(quota, F.col("session_count")).alias("taken"))


def session_sample(actions: DataFrame, total: int = SAMPLE_SIZE, seed: str = "0",
                   task_id: str | None = None, draw=proportional_sample) -> DataFrame:
    """The proportional sample of session summaries (random_session_info);
    ``draw``: ``proportional_sample`` or, with the same rows, ``bucket_sample``."""
    b = session_bounds(actions).withColumn("day_hour", F.substring("start_time", 1, 13))
    drawn = draw(b, "day_hour", "session_id", total, seed)
    # Proven size bound: sum over hours of round(n_h / n * total) is at most
    # total + (number of start hours) / 2, whatever the log size.
    ids = F.broadcast(drawn.select("session_id"))
    # the semi join keeps every action of a drawn session, so the summary of
    # those actions carries the same bounds as the draw: no join back
    out = _summary(actions.join(ids, "session_id", "left_semi"))
    if task_id is not None:
        out = out.select(F.lit(task_id).alias("task_id"), *SUMMARY_COLUMNS)
    return out
