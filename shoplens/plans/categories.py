"""Q3 top categories by clicks, orders, payments; Q4 top sessions per top category.

- ``category_action_counts``: one (category, action) item per click, and one
  per element of an order / pay comma list (exclusive: click first, then a
  non-empty order list, then a non-empty pay list); counted with partial
  aggregation, so the shuffle carries one row per key and task.
- ``category_top``: a pivot by conditional sums, then ``orderBy().limit(n)``
  (``TakeOrderedAndProject``: each task keeps its own top n).
- ``category_session_top``: the clicks of the top categories (a semi join
  with at most n ids, broadcast by the planner from the limit's row bound)
  counted per (category, session), then
  ``row_number() <= n`` per category with ``WindowGroupLimit``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions import comma_list, has_list, is_click
from shoplens.operators.topn import top_n_per_group

ACTIONS = ("click", "order", "pay")


def items_of_action() -> tuple[Column, Column]:
    """The category ids (text) an action counts for, null or empty if none, and its kind."""
    click = is_click("click_category_id")
    order = ~click & has_list("order_category_ids")
    pay = ~click & ~order & has_list("pay_category_ids")
    ids = (F.when(click, F.array(F.col("click_category_id").cast("string")))
           .when(order, comma_list("order_category_ids"))
           .when(pay, comma_list("pay_category_ids")))
    action = (F.when(click, F.lit("click")).when(order, F.lit("order"))
              .when(pay, F.lit("pay")))
    return ids, action


def category_actions(actions: DataFrame) -> DataFrame:
    """One row per counted (category_id, action); category ids are text."""
    ids, action = items_of_action()
    # explode_outer + a filter on the generated column: a row without an
    # action (ids null) or with an empty list gives one null category, which
    # the filter drops. Filtering before the generator would be pushed into
    # the scan with the whole CASE inlined (and re-evaluated) there.
    return (actions.select(F.explode_outer(ids).alias("category_id"), action.alias("action"))
            .where(F.col("category_id").isNotNull()))


def category_action_counts(actions: DataFrame) -> DataFrame:
    """category_id, action, n."""
    return (category_actions(actions).groupBy("category_id", "action")
            .agg(F.count(F.lit(1)).alias("n")))


def category_counts(actions: DataFrame) -> DataFrame:
    """category_id, click_count, order_count, pay_count (missing = 0)."""
    c = category_actions(actions)
    return c.groupBy("category_id").agg(
        *[F.count(F.when(F.col("action") == a, 1)).alias(f"{a}_count") for a in ACTIONS])


def category_top(actions: DataFrame, n: int = 10, task_id: str | None = None) -> DataFrame:
    """Top n categories by click, then order, then pay count (ties by id)."""
    return top_of_counts(category_counts(actions), n, task_id)


def top_of_counts(counts: DataFrame, n: int = 10, task_id: str | None = None) -> DataFrame:
    """The top n of category_id, click_count, order_count, pay_count rows."""
    top = (counts
           .orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                    F.asc("category_id"))
           .limit(n))
    if task_id is not None:
        top = top.select(F.lit(task_id).alias("task_id"), *top.columns)
    return top


def category_session_top(actions: DataFrame, top_categories: DataFrame, n: int = 10,
                         task_id: str | None = None) -> DataFrame:
    """Per top category, the n sessions with most clicks in it (ties by
    session id): category_id, session_id, click_count."""
    # No hint: a top-n frame carries its row bound (the limit) and a written
    # top-10 table its file size, so the planner broadcasts it from those
    # statistics; any larger frame given here gets a shuffle join instead.
    cats = top_categories.select("category_id").distinct()
    clicks = actions.select(F.col("click_category_id").cast("string").alias("category_id"),
                            "session_id")
    counts = (clicks.join(cats, "category_id", "left_semi")
              .groupBy("category_id", "session_id")
              .agg(F.count(F.lit(1)).alias("click_count")))
    out = top_n_per_group(counts, ["category_id"],
                          [F.desc("click_count"), F.asc("session_id")], n)
    if task_id is not None:
        out = out.select(F.lit(task_id).alias("task_id"), *out.columns)
    return out
