"""Top-n inside groups and proportional sampling, planned with WindowGroupLimit.

A ``row_number()`` / ``rank()`` window followed by a filter against a literal
limit is planned by Spark with ``WindowGroupLimit`` on both sides of the
shuffle: every map partition keeps at most n rows per group before the
exchange, so a group of any size ships at most n rows per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    rank_name: str | None = None, ties: bool = False) -> DataFrame:
    """Rows ranked ``<= n`` per group.

    ``ties=False`` gives exactly n rows (``row_number``; make ``order`` total
    for a deterministic result), ``ties=True`` keeps equal rows (``rank``).
    """
    w = Window.partitionBy(*group).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    name = rank_name or "_rn"
    out = df.withColumn(name, fn.over(w)).where(F.col(name) <= n)
    return out if rank_name else out.drop(name)


def proportional_sample(items: DataFrame, stratum: str, key: str, total: int,
                        seed: str = "0") -> DataFrame:
    """Take ``round(n_stratum / n_all * total)`` items of every stratum,
    uniformly at random, without repetition (never more than the stratum has).

    The draw is a seeded hash order: ``md5(key || ':' || seed)``, so a run is
    repeatable and equal to the SQL statement of the same rule. Every quota is
    at most ``total``, so the ``row_number() <= total`` bound lets Spark cut
    each stratum per partition before the shuffle; the quota table (one row
    per stratum) joins the ranked items on the stratum: broadcast by the
    planner when small, else co-partitioned with them (both are keyed by the
    stratum), so the items are not shuffled again.
    Output: the item columns plus ``quota``.
    """
    per = items.groupBy(stratum).agg(F.count(F.lit(1)).alias("_n"))
    n_all = per.select(F.sum("_n")).scalar()
    quota = per.select(
        stratum,
        F.least(F.round(F.try_divide(F.col("_n").cast("double"), n_all.cast("double"))
                        * F.lit(float(total))).cast("bigint"), F.col("_n")).alias("quota"))
    w = Window.partitionBy(stratum).orderBy(F.md5(F.concat(F.col(key).cast("string"),
                                                           F.lit(":" + seed))))
    ranked = items.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= total)
    return (ranked.join(quota, stratum)
            .where(F.col("_rn") <= F.col("quota"))
            .drop("_rn"))


def bucket_sample(items: DataFrame, stratum: str, key: str, total: int, seed: str = "0", digits: int = 3) -> DataFrame:
    """The rows of ``proportional_sample`` from mergeable counts, without a rank over all items.

    An item's place in the draw is its hash; the first ``digits`` hex digits of
    it are its bucket. The counts per (stratum, bucket) merge on the map side and
    say, with the quota (known only when all are counted), which buckets lie
    below the cut and how many items come before each. Only items of those
    buckets are ranked, each bucket by itself: about ``total`` items and one
    bucket more per stratum, whatever the number of items. A stratum has at most
    16**digits counts. Null strata are a stratum of their own."""
    marked = items.withColumn("_digest", F.md5(F.concat(F.col(key).cast("string"), F.lit(":" + seed))))
    marked = marked.withColumn("_bucket", F.substring("_digest", 1, digits))
    counts = marked.groupBy(F.col(stratum).alias("_stratum"), "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    n_all = counts.select(F.sum("_n")).scalar()
    whole = Window.partitionBy("_stratum")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = counts.select("_stratum", "_bucket", before.alias("_before"), F.sum("_n").over(whole).alias("_rows"))
    share = F.try_divide(F.col("_rows").cast("double"), n_all.cast("double")) * F.lit(float(total))
    cuts = (cuts.withColumn("quota", F.least(F.round(share).cast("bigint"), F.col("_rows")))
            .where(F.col("_before") < F.col("quota")).withColumnRenamed("_bucket", "_at"))
    same = marked[stratum].eqNullSafe(cuts["_stratum"]) & (marked["_bucket"] == cuts["_at"])
    inside = Window.partitionBy("_stratum", "_at").orderBy("_digest")
    return (marked.join(cuts, same).withColumn("_rn", F.col("_before") + F.row_number().over(inside))
            .where(F.col("_rn") <= F.col("quota")).select(*items.columns, "quota"))
