"""The sample from mergeable counts: the same rows as the ranked one, and no rank over all items."""

import re

import pytest
from pyspark.sql import functions as F

from shoplens.operators.topn import bucket_sample, proportional_sample
from test_plans import plan


def items_of(spark, n):
    """Strata of many sizes: one holds a third of the rows, some a single one, one is null."""
    g = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("g"), F.floor(F.pow(F.col("id") % 997, F.lit(0.6)))))
    return spark.range(n).select(F.col("id").alias("k"), g.alias("g"))


def rows(df):
    return sorted((r.g or "", r.k, r.quota) for r in df.collect())


@pytest.mark.parametrize("total, digits", [(100, 3), (1000, 1), (7, 2), (100_000, 3)])
def test_same_rows_as_the_ranked_sample(spark, total, digits):
    items = items_of(spark, 6000).where("g is not null")
    got = rows(bucket_sample(items, "g", "k", total, "s", digits))
    assert got == rows(proportional_sample(items, "g", "k", total, "s"))
    assert len({k for _, k, _ in got}) == len(got)


def test_a_null_stratum_is_drawn_from(spark):
    got = [r.quota for r in bucket_sample(items_of(spark, 6000), "g", "k", 600, "s").where("g is null").collect()]
    n = items_of(spark, 6000).where("g is null").count()
    assert got and len(got) == got[0] == round(n / 6000 * 600)


def test_empty_items(spark):
    assert bucket_sample(items_of(spark, 0), "g", "k", 10).collect() == []


def test_only_buckets_below_the_cut_are_ranked(spark):
    p = plan(bucket_sample(items_of(spark, 6000), "g", "k", 50))
    ranks = [x for x in p.split("\n\n") if re.search(r"\) Window\b", x) and "row_number" in x]
    assert ranks and all(re.search(r"row_number\(\) windowspecdefinition\(_stratum#\d+, _at#\d+", x) for x in ranks)
