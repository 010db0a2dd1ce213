"""Q5: conversion rate of each step of a page flow.

``rate(a-b) = round(1000 * transitions(a->b) / visits(a)) / 10`` where a
transition is a pair of successive actions of one session (ordered by time,
then event id) and visits count the actions on page a. A step that never
happens gives no row; a step whose first page has no visit divides by 1.

Successive pairs come from ``successor_pairs``: sessions are cut into their
minutes, so a hot session is sorted by many tasks; only the pairs that are
steps of the flow are kept (a semi join with n-1 step rows, broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.operators.sequence import successor_pairs


def flow_steps(spark: SparkSession, flow: Sequence[int]) -> DataFrame:
    """The n-1 steps (from_page, to_page) of a flow (a tiny literal table)."""
    pairs = list(zip(flow[:-1], flow[1:]))
    return spark.createDataFrame(pairs, "from_page bigint, to_page bigint")


def page_visits(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """page_id, visit_count for the pages a step starts from."""
    starts = sorted(set(int(p) for p in flow[:-1]))
    return (actions.where(F.col("page_id").isin(starts))
            .groupBy("page_id").agg(F.count(F.lit(1)).alias("visit_count")))


def _pairs(actions: DataFrame) -> DataFrame:
    """(from_page, to_page) of every action; the last of a session has no successor."""
    a = actions.select("session_id", "page_id", "action_time", "event_id",
                       F.substring("action_time", 1, 16).alias("_minute"))
    pairs = successor_pairs(a, ["session_id"], "_minute", ["action_time", "event_id"],
                            "page_id", "to_page")
    return pairs.select(F.col("page_id").alias("from_page"), "to_page")


def page_transitions(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """from_page, to_page, jump_count for the flow's steps that occur."""
    steps = F.broadcast(flow_steps(actions.sparkSession, flow))
    return (_pairs(actions).where(F.col("to_page").isNotNull())
            .join(steps, ["from_page", "to_page"], "left_semi")
            .groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("jump_count")))


def page_convert_rate(actions: DataFrame, flow: Sequence[int],
                      task_id: str | None = None) -> DataFrame:
    """page_jump ``'a-b'`` and rate (percent, one decimal)."""
    # the pairs hold every action with its page (the last ones with a null
    # successor), so visits and jumps are counted in one pass over the log
    starts = sorted(set(int(p) for p in flow[:-1]))
    counted = (_pairs(actions).where(F.col("from_page").isin(starts))
               .groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("jump_count")))
    visits = F.sum("jump_count").over(Window.partitionBy("from_page"))
    j = (counted.withColumn("visit_count", visits)
         .join(F.broadcast(flow_steps(actions.sparkSession, flow).distinct()),
               ["from_page", "to_page"], "left_semi"))
    rate = F.round(F.col("jump_count") * F.lit(1000) / F.col("visit_count").cast("double")) / F.lit(10.0)
    cols = [F.concat(F.col("from_page").cast("string"), F.lit("-"),
                     F.col("to_page").cast("string")).alias("page_jump"), rate.alias("rate")]
    if task_id is not None:
        cols.insert(0, F.lit(task_id).alias("task_id"))
    return j.select(*cols)
