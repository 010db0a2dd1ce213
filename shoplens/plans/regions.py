"""Q6: the most clicked products per area, with the shares of their top cities.

Plan shape (what makes it hold at scale):

1. The visit log is reduced first: ``count(*)`` per ``(city_id, click_product_id)``
   with map-side partial aggregation. Everything after works on at most
   cities x products rows, whatever the log size; a hot key is one row after
   the partial aggregate.
2. The dimensions join without a hint: file statistics and AQE decide between
   a broadcast and a shuffle join of two keyed aggregates.
3. The city remark (``city_remark``) is two-level grouping with built-ins:
   counts per (area, product, city), then one window per (area, product)
   whose size is bounded by the number of cities (a dimension), keeping the
   top two cities. One repartition by (area, product) serves the city-level
   aggregation, the window and the final grouping (no shuffle between).
4. ``rank() <= n`` per area is planned with ``WindowGroupLimit``: each map
   partition keeps its own top-n per area before the shuffle, so the area
   partitions stay small even though the product count grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.functions import whole_pct

# Fixed values that must equal the reference's output text.
OTHER_CITIES_LABEL = "其他"  # "others": the rest after the two top cities
REMARK_TOP_CITIES = 2


def city_product_clicks(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """Clicks per (area, product, city): the inner joins of log, city, product.

    Columns: area, product_id, product_name, city_name, n. An action whose
    city or clicked product is unknown finds no partner and is dropped, as are
    actions without a click (product -1).
    """
    pre = (actions.where(F.col("click_product_id") != -1).groupBy("city_id", "click_product_id")
           .agg(F.count(F.lit(1)).alias("n")))
    city = cities.select("city_id", "city_name", "area")
    prod = products.select("product_id", "product_name")
    joined = (pre.join(city, "city_id")
              .join(prod, pre.click_product_id == prod.product_id))
    # One shuffle by (area, product) serves both this aggregation (its keys are
    # a superset) and the remark window / totals that follow.
    return (joined.repartition("area", "product_id", "product_name")
            .groupBy("area", "product_id", "product_name", "city_name")
            .agg(F.sum("n").alias("n")))


def area_product_clicks(city_clicks: DataFrame) -> DataFrame:
    """``count(*)`` per (area, product_id, product_name) as ``clickcount``."""
    return (city_clicks.groupBy("area", "product_id", "product_name")
            .agg(F.sum("n").alias("clickcount")))


def city_remark(city_clicks: DataFrame, top: int = REMARK_TOP_CITIES) -> DataFrame:
    """Per (area, product): clickcount and the city remark text.

    Remark: cities with a null or empty name are skipped; each city's share is
    a whole percent (``45.67 %`` -> ``45.0``); the two biggest cities (ties by
    name) as ``name:45.0%``, joined by ``,``; with more than two cities the
    rest follows as ``其他:<100 - both shares>%``; no named city gives ``''``.
    """
    keys = ["area", "product_id", "product_name"]
    named = F.col("city_name").isNotNull() & (F.length("city_name") > 0)
    w_all = Window.partitionBy(*keys)
    w_rank = w_all.orderBy(F.when(named, 0).otherwise(1), F.desc("n"), F.asc("city_name"))
    per_city = city_clicks.select(
        *keys, "city_name", "n", named.alias("named"),
        F.sum("n").over(w_all).alias("clickcount"),
        F.sum(F.when(named, F.col("n"))).over(w_all).alias("named_total"),
        F.count(F.when(named, F.lit(1))).over(w_all).alias("n_cities"),
        F.row_number().over(w_rank).alias("rn"),
    )
    top_rows = per_city.where(F.col("rn") <= top)  # rn 1 keeps every product
    share = whole_pct(F.col("n"), F.col("named_total"))
    agg = (top_rows.groupBy(*keys)
           .agg(F.first("clickcount").alias("clickcount"),
                F.first("n_cities").alias("n_cities"),
                F.sort_array(F.collect_list(F.when(
                    F.col("named") & (F.col("rn") <= top),
                    F.struct(F.col("rn"), F.col("city_name"), share.alias("pct"))))).alias("tops")))
    shown = F.transform("tops", lambda t: F.concat(
        t.getField("city_name"), F.lit(":"), t.getField("pct").cast("string"), F.lit("%")))
    rest = F.lit(100.0) - F.aggregate("tops", F.lit(0.0), lambda acc, t: acc + t.getField("pct"))
    rest_txt = F.concat(F.lit(OTHER_CITIES_LABEL + ":"), rest.cast("string"), F.lit("%"))
    remark = F.when(F.col("n_cities") > top,
                    F.array_join(F.concat(shown, F.array(rest_txt)), ","))
    remark = remark.otherwise(F.array_join(shown, ","))
    return agg.select(*keys, "clickcount", remark.alias("cityremark"))


# Cities a group's counts hold exactly; the sketch behind them merges on the map side.
MAX_CITIES = 10_000


def register_city_remark(spark: SparkSession) -> None:
    """The remark as the SQL function ``city_remark(cities, clicks)`` (U2).

    Spark has no SQL function that contains an aggregate, so the aggregate is the
    mergeable one below it: ``city_counts()`` is the counts per city, partially
    aggregated before the shuffle. ``clicks`` is the number of clicks with a named
    city; if the counts do not add up to it (more than ``MAX_CITIES`` cities in a
    group, where they would be estimates), the function raises an error."""
    first = """slice(array_sort(cities, (a, b) -> CASE WHEN a.count > b.count THEN -1 WHEN a.count < b.count THEN 1
                     WHEN a.item < b.item THEN -1 WHEN a.item > b.item THEN 1 ELSE 0 END), 1, {n})"""
    first = first.format(n=REMARK_TOP_CITIES)
    share = "CAST(floor(round(CAST(t.count AS DOUBLE) / CAST(clicks AS DOUBLE) * 1000D) / 10) AS DOUBLE)"
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION city_remark(cities ARRAY<STRUCT<item STRING, count BIGINT>>, clicks BIGINT)
RETURNS STRING
RETURN CASE
  WHEN clicks = 0 THEN ''
  WHEN aggregate(cities, 0L, (s, t) -> s + t.count) <> clicks
    THEN raise_error('city_remark: the counts of the cities do not add up to the clicks')
  ELSE array_join(concat(
    transform({first}, t -> concat(t.item, ':', CAST({share} AS STRING), '%')),
    CASE WHEN size(cities) > {REMARK_TOP_CITIES} THEN array(concat('{OTHER_CITIES_LABEL}:', CAST(
      aggregate({first}, 100D, (s, t) -> s - {share}) AS STRING), '%')) ELSE CAST(array() AS ARRAY<STRING>) END), ',')
END""")


def city_counts(name: str = "city_name") -> str:
    """The two arguments of ``city_remark`` over a column of city names, as SQL."""
    named = f"FILTER (WHERE {name} <> '')"  # neither null nor empty
    return f"approx_top_k({name}, {MAX_CITIES}, {MAX_CITIES}) {named}, count(*) {named}"


def area_top_products_sql(actions: DataFrame, cities: DataFrame, products: DataFrame, n: int = 3) -> DataFrame:
    """``area_top_products`` as the three statements an analyst would write, with
    ``city_remark`` by name over the joined clicks."""
    spark = actions.sparkSession
    register_city_remark(spark)
    joined = spark.sql("""
        SELECT c.area, c.city_name, p.product_id, p.product_name
        FROM {v} AS v JOIN {c} AS c ON v.city_id = c.city_id JOIN {p} AS p ON p.product_id = v.click_product_id
        WHERE v.click_product_id <> -1""", v=actions, c=cities, p=products)
    counted = spark.sql(f"""
        SELECT area, product_id, product_name, count(*) AS clickcount, city_remark({city_counts()}) AS cityremark
        FROM {{t}} GROUP BY area, product_id, product_name""", t=joined)
    return spark.sql("""
        SELECT area, product_id, product_name, clickcount, cityremark
        FROM (SELECT *, rank() OVER (PARTITION BY area ORDER BY clickcount DESC) AS rk FROM {t}) WHERE rk <= {n}""",
                     t=counted, n=n)


def area_top_products(actions: DataFrame, cities: DataFrame, products: DataFrame,
                      n: int = 3) -> DataFrame:
    """Products with ``rank() <= n`` by clicks per area (ties share a rank, so
    an area may show more than n rows), with their city remark. The clicks are
    ranked first; remarks are built for the products that remain."""
    clicks = city_product_clicks(actions, cities, products)
    w = Window.partitionBy("area").orderBy(F.desc("clickcount"))
    top = (area_product_clicks(clicks).withColumn("rk", F.rank().over(w)).where(F.col("rk") <= n)
           .select("area", "product_id", "product_name"))
    # null-safe: an area or a name may be null
    same = [clicks[c].eqNullSafe(top[c]) for c in ("area", "product_id", "product_name")]
    return (city_remark(clicks.join(top, same[0] & same[1] & same[2], "left_semi"))
            .select("area", "product_id", "product_name", "clickcount", "cityremark"))
