"""Batch twins of the ad-click questions Q7-Q10 (the stream replayed as a table).

Input: click rows ``ts`` (TIMESTAMP), area, city, user_id, ads_id, event_id.
Day and minute labels come from the click's own time in the session zone
(UTC), so a late click adds to its own day and minute.

Q7 blacklist, closed form. The stream is cut into micro-batches of
``batch_seconds``; at batch b a user is blocked for good (all ads, all days)
if one of the user's (ad, day) keys present in b had more than ``threshold``
clicks in the batches before b; the user's clicks up to and including b are
kept, later ones dropped. A user is never filtered before being blocked, so
the counts deciding the block are the unfiltered ones, and

    blocked_batch(user) = min b over keys in b with
        sum(n) over (user, ad, day ordered by batch, up to b-1) > threshold

This is a per-key running sum (window size bounded by the batches of one day)
and a per-user minimum: no global state, no driver collect; equal to the
micro-batch simulation (tests/test_ads.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import pairs_json
from shoplens.operators import keyfilter
from shoplens.operators.topn import top_n_per_group

# Fixed values of the reference's streaming job.
BATCH_SECONDS = 5
BLACKLIST_THRESHOLD = 20
LAST_MINUTES = 60
TOP_ADS = 3


def with_labels(clicks: DataFrame, batch_seconds: int = BATCH_SECONDS) -> DataFrame:
    """Add ts_ms, day (``yyyy-MM-dd``) and the micro-batch index."""
    ms = F.unix_millis("ts")
    return clicks.select(
        "*", ms.alias("ts_ms"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.floor(ms / F.lit(batch_seconds * 1000)).alias("batch"))


def ads_blacklist(clicks: DataFrame, batch_seconds: int = BATCH_SECONDS,
                  threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """user_id, blocked_batch: users the dynamic blacklist blocks."""
    c = with_labels(clicks, batch_seconds)
    per_batch = (c.groupBy("user_id", "ads_id", "day", "batch")
                 .agg(F.count(F.lit(1)).alias("n")))
    w = (Window.partitionBy("user_id", "ads_id", "day").orderBy("batch")
         .rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(F.sum("n").over(w), F.lit(0))
    return (per_batch.select("user_id", "batch", before.alias("_before"))
            .where(F.col("_before") > threshold)
            .groupBy("user_id").agg(F.min("batch").alias("blocked_batch")))


def ads_kept_clicks(clicks: DataFrame, batch_seconds: int = BATCH_SECONDS,
                    threshold: int = BLACKLIST_THRESHOLD,
                    blacklist: DataFrame | None = None) -> DataFrame:
    """The clicks that pass the blacklist (input columns + ts_ms, day, batch)."""
    bl = blacklist if blacklist is not None else ads_blacklist(clicks, batch_seconds, threshold)
    c = with_labels(clicks, batch_seconds)
    return (c.join(bl, "user_id", "left")
            .where(F.col("blocked_batch").isNull() | (F.col("batch") <= F.col("blocked_batch")))
            .drop("blocked_batch"))


def ads_kept_clicks_filtered(clicks: DataFrame, blacklist: DataFrame, shape: keyfilter.Shape,
                             batch_seconds: int = BATCH_SECONDS) -> DataFrame:
    """``ads_kept_clicks`` with a stored blacklist (user_id, blocked_batch) behind a
    bitmap filter: only clicks of users the filter lets through are joined with it."""
    c = with_labels(clicks, batch_seconds)
    members = keyfilter.build(blacklist, "user_id", shape)
    return keyfilter.exclude(c, "user_id", blacklist, members, shape, F.col("batch") <= F.col("blocked_batch"))


def ads_daily_totals(kept: DataFrame) -> DataFrame:
    """day, area, city, ads_id, clicks: running totals per day (Q8)."""
    if "day" not in kept.columns:
        kept = kept.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return (kept.groupBy("day", "area", "city", "ads_id")
            .agg(F.count(F.lit(1)).alias("clicks")))


def ads_area_top(totals: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """day, area, ads_id, clicks, rank: the n most clicked ads per day and
    area, summed over the area's cities (ties by ad id) (Q9)."""
    return top_of_areas(totals.groupBy("day", "area", "ads_id").agg(F.sum("clicks").alias("clicks")), n)


def top_of_areas(per_area: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """``ads_area_top`` of day, area, ads_id, clicks rows, one per key."""
    return top_n_per_group(per_area, ["day", "area"], [F.desc("clicks"), F.asc("ads_id")], n,
                           rank_name="rank")


def ads_area_top_json(top: DataFrame) -> DataFrame:
    """day, area, top_ads: ``[{"ad":clicks},...]`` in rank order."""
    g = top.groupBy("day", "area").agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col("ads_id").alias("k"),
                                             F.col("clicks").alias("v")))).alias("_l"))
    return g.select("day", "area", pairs_json("_l").alias("top_ads"))


def ads_last_hour(kept: DataFrame, minutes: int = LAST_MINUTES) -> DataFrame:
    """ads_id, minute (``HH:mm``), clicks: per ad, the clicks of each minute in
    the last ``minutes`` before the newest click, cut at the raw click (Q10)."""
    newest = kept.select(F.max("ts")).scalar()
    recent = kept.where((F.col("ts") > newest - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
                        & (F.col("ts") <= newest))
    per_min = (recent.groupBy("ads_id", F.date_trunc("minute", "ts").alias("_minute"))
               .agg(F.count(F.lit(1)).alias("clicks")))
    return per_min.select("ads_id", F.date_format("_minute", "HH:mm").alias("minute"), "clicks",
                          "_minute")


def ads_last_hour_json(last_hour: DataFrame) -> DataFrame:
    """ads_id, minutes: ``[{"HH:mm":clicks},...]`` in time order."""
    g = last_hour.groupBy("ads_id").agg(
        F.sort_array(F.collect_list(F.struct("_minute", F.col("minute").alias("k"),
                                             F.col("clicks").alias("v")))).alias("_l"))
    return g.select("ads_id", pairs_json("_l").alias("minutes"))
