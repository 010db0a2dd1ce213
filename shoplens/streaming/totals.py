"""Running totals, top ads and late clicks in Spark's own state (Q8, Q9).

One streaming query counts every click at two grains in one aggregation,
``groupBy(day window, grain, area, city, ad)`` in update mode: per city (Q8)
and per area (what Q9 ranks). Its state lives in the state store and is given
up when the watermark passes the end of a day; a micro-batch works on the keys it
touches, however many keys there are.

Every micro-batch lands under ``log/batch_id=<b>``, in one write that a replayed
batch overwrites with the same rows:

- ``kind=total``: the totals that changed, each with its new running value;
- ``kind=top``: the top ads of every (day, area) still open. Totals only grow, so
  the new list is among the old list and the ads the batch touched: nothing else
  is ranked, and a list never has more than ``n`` rows;
- ``kind=late``: the clicks that came after their day was given up, as they are.
  Spark drops them before the state; this side output has the same rows because
  it uses the same rule: the end of the day is not after the newest click of the
  batches before the last one, less the lateness (a batch's late rows are judged
  by the watermark of the batch before);
- ``kind=newest``: the newest click up to this batch, of which that rule is made.

The totals of open days can also be read from the state itself, without the log
(``state_totals``), one key at a time if need be.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoplens.plans.ads import TOP_ADS
from shoplens.session import prepare
from shoplens.streaming.landing import exists

KEYS = ["day", "area", "city", "ads_id"]
GRAINS = ("city", "area")
LOG_SCHEMA = ("ts timestamp, area string, city string, user_id bigint, ads_id bigint, event_id bigint, "
              "clicks bigint, rank int, us bigint, batch_id bigint, kind string, day string")
TOP_SCHEMA = "area string, ads_id bigint, clicks bigint, rank int, day string"
CLICK = ["ts", "area", "city", "user_id", "ads_id", "event_id"]
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(interval: str) -> int:
    """A lateness such as ``1 day`` or ``90 minutes`` in seconds."""
    got = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", interval)
    if not got:
        raise ValueError(f"not an interval of seconds, minutes, hours or days: {interval!r}")
    return int(got[1]) * UNITS[got[2]]


def running_totals(clicks: DataFrame, lateness: str) -> DataFrame:
    """(day_start, grain, area, city, ads_id, clicks): running totals of a stream of clicks."""
    c = clicks.where(F.col("ts").isNotNull()).withWatermark("ts", lateness)
    # two rows per click until the partial aggregation, which is before the shuffle
    c = c.select("ts", "area", "city", "ads_id", F.explode(F.array(*map(F.lit, GRAINS))).alias("grain"))
    c = c.withColumn("city", F.when(F.col("grain") == "city", F.col("city")))
    counted = c.groupBy(F.window("ts", "1 day"), "grain", "area", "city", "ads_id").agg(F.count(F.lit(1)).alias("clicks"))
    return counted.select(F.col("window.start").alias("day_start"), "grain", "area", "city", "ads_id", "clicks")


def _batch(clicks: DataFrame, lateness: str) -> DataFrame:
    """What the sink gets: changed totals (kind total, area) and the batch's clicks (kind raw)."""
    totals = running_totals(clicks, lateness).select(
        F.when(F.col("grain") == "city", "total").otherwise("area").alias("kind"),
        F.col("day_start").alias("ts"), "area", "city", F.lit(None).cast("bigint").alias("user_id"), "ads_id",
        F.lit(None).cast("bigint").alias("event_id"), "clicks")
    raw = clicks.where(F.col("ts").isNotNull()).select(F.lit("raw").alias("kind"), *CLICK,
                                                       F.lit(None).cast("bigint").alias("clicks"))
    return totals.union(raw)


class Newest:
    """The newest click up to each batch (microseconds), in memory for the running
    query, from the landed rows after a restart or for a replayed batch."""

    def __init__(self, out_dir: str):
        self.out_dir, self.known = out_dir, {}

    def upto(self, spark: SparkSession, batch_id: int) -> int:
        if batch_id < 0:
            return 0
        if batch_id not in self.known:
            path = os.path.join(self.out_dir, "log", f"batch_id={batch_id}", "kind=newest")
            self.known[batch_id] = spark.read.schema("us bigint").parquet(path).first()["us"]
        return self.known[batch_id]

    def add(self, batch_id: int, us: int) -> None:
        self.known = {b: x for b, x in self.known.items() if b >= batch_id - 2} | {batch_id: us}


LAND = """
WITH fresh AS (
  SELECT date_format(ts, 'yyyy-MM-dd') AS day, area, ads_id, clicks FROM _totals_batch WHERE kind = 'area'),
pool AS (
  SELECT day, area, ads_id, max(clicks) AS clicks
  FROM (SELECT day, area, ads_id, clicks FROM fresh UNION ALL
        SELECT day, area, ads_id, clicks FROM _totals_top WHERE day > '{closed}') GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY day, area ORDER BY clicks DESC, ads_id) AS rank FROM pool)
SELECT CAST(NULL AS timestamp) AS ts, area, CAST(NULL AS string) AS city, CAST(NULL AS bigint) AS user_id, ads_id,
       CAST(NULL AS bigint) AS event_id, clicks, rank, CAST(NULL AS bigint) AS us, 'top' AS kind, day
FROM ranked WHERE rank <= {n}
UNION ALL
SELECT NULL, area, city, NULL, ads_id, NULL, clicks, NULL, NULL, kind, date_format(ts, 'yyyy-MM-dd')
FROM _totals_batch WHERE kind = 'total'
UNION ALL
SELECT ts, area, city, user_id, ads_id, event_id, NULL, NULL, NULL, 'late', date_format(ts, 'yyyy-MM-dd')
FROM _totals_batch WHERE kind = 'raw' AND unix_micros(date_trunc('day', ts)) + 86400000000 <= {late_us}
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, {newest_us}, 'newest', 'all'
"""


def start_totals(clicks: DataFrame, out_dir: str, checkpoint: str, lateness: str = "1 day", n: int = TOP_ADS,
                 trigger: dict | None = None) -> StreamingQuery:
    """Totals, top ads and late clicks of a stream of clicks (ts, area, city, user_id, ads_id, event_id)."""
    prepare(clicks.sparkSession)
    newest, delay = Newest(out_dir), seconds(lateness) * 1_000_000

    def watermark(spark: SparkSession, batch_id: int) -> int:
        """The watermark made by the batches up to this one; Spark's has whole milliseconds."""
        return max(0, newest.upto(spark, batch_id) // 1000 * 1000 - delay)

    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df = df.persist()
        top = max(newest.upto(spark, batch_id - 1),
                  df.where("kind = 'raw'").agg(F.unix_micros(F.max("ts"))).first()[0] or 0)
        # lists of days given up are left behind in the batch that ranked them last
        closed = spark.sql(f"SELECT date_format(timestamp_micros({watermark(spark, batch_id - 2)}) "
                           "- INTERVAL 1 DAY, 'yyyy-MM-dd')").first()[0]
        before = os.path.join(out_dir, "log", f"batch_id={batch_id - 1}", "kind=top")
        lists = (spark.read.schema(TOP_SCHEMA).parquet(before) if exists(spark, before)
                 else spark.createDataFrame([], TOP_SCHEMA))
        df.createOrReplaceTempView("_totals_batch")
        lists.createOrReplaceTempView("_totals_top")
        out = spark.sql(LAND.format(n=int(n), closed=closed, newest_us=top, late_us=watermark(spark, batch_id - 2)))
        (out.write.mode("overwrite").partitionBy("kind", "day")
         .parquet(os.path.join(out_dir, "log", f"batch_id={batch_id}")))
        newest.add(batch_id, top)
        df.unpersist()

    return (_batch(clicks, lateness).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(sink).trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def dropped_keys(query: StreamingQuery) -> int:
    """Keys of late clicks that the query's state refused, from its own metrics
    (the last progress reports that Spark keeps)."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


# --- readers -----------------------------------------------------------------------

def _log(spark: SparkSession, out_dir: str, kind: str) -> DataFrame:
    return (spark.read.schema(LOG_SCHEMA).parquet(os.path.join(out_dir, "log")).where(F.col("kind") == kind))


def read_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """day, area, city, ads_id, clicks: the last running value of each key (the largest: totals only grow)."""
    return _log(spark, out_dir, "total").groupBy(*KEYS).agg(F.max("clicks").alias("clicks"))


def read_top(spark: SparkSession, out_dir: str) -> DataFrame:
    """day, area, ads_id, clicks, rank: the last list of each (day, area)."""
    top = _log(spark, out_dir, "top")
    last = top.groupBy("day", "area").agg(F.max("batch_id").alias("batch_id"))
    same = [top["day"] == last["day"], top["area"].eqNullSafe(last["area"]), top["batch_id"] == last["batch_id"]]
    return top.join(last, same, "left_semi").select("day", "area", "ads_id", "clicks", "rank")


def read_late(spark: SparkSession, out_dir: str) -> DataFrame:
    """The late clicks, with the batch they came in."""
    return _log(spark, out_dir, "late").select(*CLICK, "day", "batch_id")


def state_totals(spark: SparkSession, checkpoint: str, grain: str = "city", batch_id: int | None = None) -> DataFrame:
    """day, area, city, ads_id, clicks of the days still open, read from the state
    store of the query with that checkpoint; ``batch_id`` reads an earlier batch's state.
    A filter on the keys is a point lookup."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return (reader.load(checkpoint).where(F.col("key.grain") == grain)
            .select(F.date_format(F.col("key.window.start"), "yyyy-MM-dd").alias("day"),
                    "key.area", "key.city", "key.ads_id", F.col("value.count").alias("clicks")))
