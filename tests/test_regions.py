import random

import pytest
from pyspark.sql import functions as F

from shoplens.plans import regions

CC = "area string, product_id long, product_name string, city_name string, n long"


def _remark(spark, rows):
    return regions.city_remark(spark.createDataFrame(rows, CC)).first().cityremark


def test_remark_top_two_and_rest(spark):
    rows = [("A", 1, "p", "a", 4567), ("A", 1, "p", "b", 3333), ("A", 1, "p", "c", 2100)]
    assert _remark(spark, rows) == "a:45.0%,b:33.0%,其他:22.0%"


def test_remark_two_cities_no_rest(spark):
    assert _remark(spark, [("A", 1, "p", "a", 2), ("A", 1, "p", "b", 1)]) == "a:66.0%,b:33.0%"


def test_remark_unnamed_cities_only(spark):
    df = spark.createDataFrame([("A", 1, "p", None, 2), ("A", 1, "p", "", 1)], CC)
    r = regions.city_remark(df).first()
    assert r.cityremark == "" and r.clickcount == 3


def test_rank_ties_give_more_rows(spark):
    cities = spark.createDataFrame([(0, "c", "A")], "city_id long, city_name string, area string")
    products = spark.createDataFrame([(i, f"p{i}", "") for i in range(5)],
                                     "product_id long, product_name string, extend_info string")
    acts = spark.createDataFrame([(0, i) for i in range(4) for _ in range(2)] + [(0, 4)],
                                 "city_id long, click_product_id long")
    out = regions.area_top_products(acts, cities, products, 3).collect()
    assert len(out) == 4 and all(r.clickcount == 2 for r in out)


def _clicks(spark, counts):
    """One row per click of (product, city): n."""
    return spark.createDataFrame([("A", p, f"p{p}", c) for (p, c), n in counts.items() for _ in range(n)],
                                 "area string, product_id long, product_name string, city_name string")


def _by_name(spark, clicks):
    regions.register_city_remark(spark)
    return spark.sql(f"SELECT product_id, count(*) AS clickcount, city_remark({regions.city_counts()}) AS cityremark "
                     "FROM {t} GROUP BY product_id", t=clicks)


def test_remark_by_name_equals_the_built_one(spark):
    rng = random.Random(3)
    counts = {(p, c): rng.randint(1, 40) for p in range(30)
              for c in rng.sample(["a", "b", "c", "d", "Ü", "", None], rng.randint(1, 6))}
    clicks = _clicks(spark, counts)
    per_city = clicks.groupBy(*clicks.columns).agg(F.count(F.lit(1)).alias("n"))
    want = {r.product_id: (r.clickcount, r.cityremark) for r in regions.city_remark(per_city).collect()}
    got = {r.product_id: (r.clickcount, r.cityremark) for r in _by_name(spark, clicks).collect()}
    assert got == want and len(want) == 30


def test_remark_by_name_merges_before_the_shuffle(spark):
    p = _by_name(spark, _clicks(spark, {(1, "a"): 2}))._jdf.queryExecution().toString()
    assert "partial_approx_top_k" in p


def test_remark_by_name_refuses_estimates(spark):
    regions.register_city_remark(spark)
    with pytest.raises(Exception, match="do not add up"):
        spark.sql("SELECT city_remark(array(named_struct('item', 'a', 'count', 2L)), 3L)").collect()
    assert spark.sql("SELECT city_remark(array(named_struct('item', 'a', 'count', 3L)), 3L)").first()[0] == "a:100.0%"


def test_counts_are_exact_up_to_the_bound(spark):
    many = spark.range(3 * regions.MAX_CITIES).selectExpr(f"concat('c', id % {regions.MAX_CITIES}) as city_name", "1 as product_id")
    r = _by_name(spark, many).first()
    assert r.clickcount == 3 * regions.MAX_CITIES and r.cityremark.startswith("c0:0.0%,c1:0.0%,其他:100.0%")
    over = spark.range(30 * regions.MAX_CITIES).selectExpr("concat('c', id) as city_name", "1 as product_id")
    with pytest.raises(Exception, match="do not add up"):
        _by_name(spark, over).collect()
