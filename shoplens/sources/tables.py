"""Readers of the given parquet tables and adapters to the shop's data model.

The shop's own tables are ``user_visit_action`` (fact), ``user_info``,
``product_info``, ``city_info`` (dimensions) and the ``ads_log`` click stream.
In this repository they are derived from the given TPC-H-ish tables with the
fixed mapping of FIXTURES.md §B; every adapter is a plain projection (plus
one join with the 25-row city dimension for the click stream), so Catalyst
prunes columns and pushes filters into the parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.schemas import GIVEN_TABLES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the shop's sources have known schemas, so no job reads a footer first."""
    reader = spark.read.schema(GIVEN_TABLES[name]) if name in GIVEN_TABLES else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _k(props: Column) -> Column:
    """The integer ``k`` of the events' ``props`` JSON ``{"k": n}``."""
    return F.get_json_object(props, "$.k").cast("bigint")


def user_visit_action(events: DataFrame, start_date: str | None = None,
                      end_date: str | None = None) -> DataFrame:
    """The visit log, one row per action (13 columns + ``event_id`` tie-break).

    Optional date bounds are also applied to the raw ``ts`` column so the
    parquet reader skips row groups (the fact would be partitioned by ``date``
    in a warehouse; here ``date`` is derived, so the bound is restated on
    ``ts``). The caller still filters on ``date``; the two agree.
    """
    ev = events
    if start_date is not None:
        ev = ev.where(F.col("ts") >= F.to_timestamp_ntz(F.lit(start_date + " 00:00:00")))
    if end_date is not None:
        ev = ev.where(F.col("ts") < F.date_add(F.to_date(F.lit(end_date)), 1)
                      .cast("timestamp_ntz"))
    ev = ev.select("event_id", "ts", "user_id", "event_type", _k(F.col("props")).alias("_k"))
    k = F.col("_k")
    eid = F.col("event_id")
    et = F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd")
    is_click = et.isin("click", "signup")
    s = lambda c: c.cast("string")
    return ev.select(
        day.alias("date"),
        F.col("user_id"),
        F.concat(s(F.col("user_id")), F.lit("-"), day).alias("session_id"),
        (k % 10 + 1).alias("page_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        F.when(et == "view", F.concat(F.lit("kw_"), s(k % 6))).alias("search_keyword"),
        F.when(is_click, k % 20 + 1).otherwise(F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.when(is_click, eid % 100).otherwise(F.lit(-1)).cast("bigint").alias("click_product_id"),
        F.when(et == "purchase", F.concat(s(k % 20 + 1), F.lit(","), s((k + 7) % 20 + 1)))
        .alias("order_category_ids"),
        F.when(et == "purchase", F.concat(s(eid % 100), F.lit(","), s((eid + 7) % 100)))
        .alias("order_product_ids"),
        F.when(et == "error", F.concat(s(k % 20 + 1), F.lit(","), s((k + 11) % 20 + 1)))
        .alias("pay_category_ids"),
        F.when(et == "error", s(eid % 100)).alias("pay_product_ids"),
        ((F.col("user_id") + k) % 25).alias("city_id"),
        eid.alias("event_id"),
    )


def user_info(customer: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    return customer.select(
        ck.alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(10) + ck % 50).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.when(ck % 5 < 3, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
    )


def city_info(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("bigint").alias("city_id"),
                    F.col("n_name").alias("city_name"),
                    F.col("r_name").alias("area")))


def product_info(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("product_id"),
                       F.col("p_name").alias("product_name"),
                       F.col("p_brand").alias("extend_info"))


def ads_log(events: DataFrame, cities: DataFrame, ads_mod: int = 6) -> DataFrame:
    """The ad-click stream as rows: ts, area, city, user_id, ads_id.

    ``ts`` is the event time as an instant (TIMESTAMP), built from the
    time-zone-free wall clock of ``events.ts`` read as UTC, so it does not
    depend on the session zone; ``ads_id = k % ads_mod + 1``.
    """
    k = _k(F.col("props"))
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              F.col("ts"))
    clicks = events.select(
        F.timestamp_micros(F.floor(micros / 1000) * 1000).alias("ts"),
        ((F.col("user_id") + k) % 25).alias("city_id"),
        F.col("user_id"),
        (k % ads_mod + 1).alias("ads_id"),
        F.col("event_id"),
    )
    city = cities.where(F.col("city_id").isNotNull()).select(
        F.col("city_id").alias("_city_id"), F.col("city_name").alias("city"), "area")
    # null-safe, with no null on the right: the same rows as by "=", for which Spark
    # would parse the JSON of every event a second time to filter null keys out
    return (clicks.join(city, F.col("city_id").eqNullSafe(F.col("_city_id")))
            .select("ts", "area", "city", "user_id", "ads_id", "event_id"))


class ShopTables:
    """The shop's tables over one directory of given parquet files (lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def actions(self, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
        return user_visit_action(self.raw("events"), start_date, end_date)

    def users(self) -> DataFrame:
        return user_info(self.raw("customer"))

    def cities(self) -> DataFrame:
        return city_info(self.raw("nation"), self.raw("region"))

    def products(self) -> DataFrame:
        return product_info(self.raw("part"))

    def ads(self, ads_mod: int = 6) -> DataFrame:
        return ads_log(self.raw("events"), self.cities(), ads_mod)
