"""Operators over rows ordered inside a group, split so a hot group is not one task.

Both operators cut each group into buckets of its ordering key (e.g. the
minute of an action): the heavy work (sort, pairing, concatenation) runs per
(group, bucket), and only one small row per (group, bucket) is combined per
group afterwards. A group holding a third of all rows is spread over as many
tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def successor_pairs(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str],
                    value: str, next_name: str | None = None) -> DataFrame:
    """Each row with the ``value`` of the next row of its group.

    The order is ``(bucket, *order)`` and must be total (add a tie column such
    as an event id). ``bucket`` must grow with the order (e.g. a time prefix).
    The last row of a group gets null; a row whose group or bucket is null has
    no place in an order and is left out. Output: all input columns plus
    ``next_name`` (default ``next_<value>``).

    Plan: one shuffle of the rows by (group, bucket) and a window there
    (``lead`` inside the bucket, ``lag`` to mark each bucket's first row). The first rows, one per (group, bucket), get the first value of the
    next non-empty bucket by a ``lead`` over the buckets of their group, and
    join back to the bucket's last row by (group, bucket).
    """
    group = list(group)
    order = list(order)
    next_name = next_name or f"next_{value}"
    gb = group + [bucket]
    w_in = Window.partitionBy(*gb).orderBy(*order)
    # "last row of its bucket" is tested on a marker, not on the value, so a
    # null value of the next row is not mistaken for the end of the bucket
    for c in gb:
        df = df.where(F.col(c).isNotNull())
    rows = df.select("*", F.lead(value).over(w_in).alias("_next_in"),
                     F.lead(F.lit(1)).over(w_in).isNull().alias("_last"),
                     F.lag(F.lit(1)).over(w_in).isNull().alias("_first"))
    w_b = Window.partitionBy(*group).orderBy(bucket)
    # the same shuffle serves both uses of ``rows`` (a row_number limit here
    # would be planned below the shuffle and make it a second one)
    bridges = (rows.where(F.col("_first"))
               .select(*gb, F.lead(value).over(w_b).alias("_next_bucket")))
    # every bucket has a bridge row; an inner join asks the same of both sides,
    # so both read one shuffle
    joined = rows.join(bridges, gb)
    out = joined.withColumn(next_name, F.when(F.col("_last"), F.col("_next_bucket"))
                            .otherwise(F.col("_next_in")))
    return out.drop("_next_in", "_next_bucket", "_first", "_last")


def ordered_concat(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str],
                   lists: dict[str, Column], sep: str = ",",
                   extra: dict[str, tuple[Column, Callable[[str], Column]]] | None = None
                   ) -> DataFrame:
    """Per group, each ``lists`` expression's non-null values joined by ``sep``
    in the order ``(bucket, *order)``; a list with no value gives ``''``.

    Values are first joined per (group, bucket) (a bounded sort), then the
    partial strings are joined per group in bucket order. A partial of a
    bucket without values is null and skipped, so an empty value ``''`` still
    leaves its separator, as in a plain join of the whole list.
    """
    group = list(group)
    order = list(order)
    names = list(lists)
    items = F.struct(*[F.col(c) for c in order], *[e.alias(n) for n, e in lists.items()])
    extra = extra or {}
    per_bucket = (df.groupBy(*group, bucket)
                  .agg(F.sort_array(F.collect_list(items)).alias("_items"),
                       *[agg.alias(n) for n, (agg, _m) in extra.items()]))
    parts = []
    for n in names:
        vals = F.transform(F.filter("_items", _not_null_field(n)), _field(n))
        parts.append(F.when(F.size(vals) > 0, F.array_join(vals, sep)).alias(n))
    partial = per_bucket.select(*group, bucket, *parts, *extra)
    merged = (partial.groupBy(*group)
              .agg(F.sort_array(F.collect_list(F.struct(bucket, *names))).alias("_parts"),
                   *[merge(n).alias(n) for n, (_a, merge) in extra.items()]))
    return merged.select(*group, *extra, *[
        F.coalesce(F.array_join(F.transform("_parts", _field(n)), sep),
                   F.lit("")).alias(n) for n in names])


def _field(name: str):
    return lambda x: x.getField(name)


def _not_null_field(name: str):
    return lambda x: x.getField(name).isNotNull()
