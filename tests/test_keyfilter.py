"""The bitmap filter: no wrong drop, the stated rate, merging, bounded size."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplens.operators import keyfilter
from shoplens.operators.keyfilter import Shape


def test_shape_is_bounded_by_keys_and_rate():
    s = Shape.for_keys(1_000_000, 0.01)
    assert 7 <= s.hashes <= 8 and s.bytes <= 1_000_000 * 12 / 8 + keyfilter.BUCKET_BYTES
    assert Shape.for_keys(0, 0.5).buckets == 1
    for bad in ((1, 0), (1, 1), (-1, 0.1)):
        with pytest.raises(ValueError):
            Shape.for_keys(*bad)


@pytest.mark.parametrize("rate", [0.1, 0.01, 0.001])
def test_members_always_pass_and_others_at_the_rate(spark, rate):
    n = 20_000
    shape = Shape.for_keys(n, rate)
    members = spark.range(n).select((F.col("id") * 7).alias("u"))
    others = spark.range(n * 5).select((F.col("id") * 7 + 3).alias("u"))
    f = keyfilter.build(members, "u", shape)
    assert f.count() <= shape.buckets and f.where(F.length("bitmap") != keyfilter.BUCKET_BYTES).count() == 0
    assert keyfilter.with_maybe(members, "u", f, shape).where("not maybe").count() == 0
    passed = keyfilter.with_maybe(others, "u", f, shape).where("maybe").count() / (n * 5)
    assert passed <= 2 * rate


def test_merged_filter_equals_the_filter_of_all(spark):
    shape = Shape.for_keys(5000, 0.05)
    parts = [spark.range(a, b).select(F.col("id").cast("string").alias("u")) for a, b in ((0, 2000), (1500, 4000), (4000, 5000))]
    whole = keyfilter.build(spark.range(5000).select(F.col("id").cast("string").alias("u")), "u", shape)
    merged = keyfilter.merge(*[keyfilter.build(p, "u", shape) for p in parts])
    rows = lambda df: sorted((r.bucket, bytes(r.bitmap)) for r in df.collect())
    assert rows(merged) == rows(whole)


@pytest.mark.parametrize("limit", [keyfilter.MAX_BROADCAST, 0])
def test_exclude_equals_the_anti_join(spark, monkeypatch, limit):
    monkeypatch.setattr(keyfilter, "MAX_BROADCAST", limit)  # broadcast, and the join by bucket
    rows = spark.range(9000).select(F.when(F.col("id") % 50 != 0, F.col("id") % 900).alias("u"), "id")
    members = spark.range(0, 900, 9).select(F.col("id").alias("u"), (F.col("id") * 3).alias("until"))
    shape = Shape.for_keys(100, 0.3)  # many false passes, which the join puts right
    f = keyfilter.build(members, "u", shape)
    got = keyfilter.exclude(rows, "u", members, f, shape)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, rows.join(members, "u", "left_anti").collect()), key=repr)
    some = keyfilter.exclude(rows, "u", members, f, shape, F.col("id") <= F.col("until"))
    want = rows.join(members, "u", "left").where("until is null or id <= until").select("u", "id")
    assert sorted(map(tuple, some.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert some.count() > got.count()


def test_empty_set_and_empty_rows(spark):
    shape = Shape.for_keys(10, 0.1)
    none = spark.createDataFrame([], "u long")
    f = keyfilter.build(none, "u", shape)
    rows = spark.range(5).withColumnRenamed("id", "u")
    assert keyfilter.exclude(rows, "u", none, f, shape).count() == 5
    assert keyfilter.exclude(none, "u", rows, keyfilter.build(rows, "u", shape), shape).count() == 0


def test_published_per_batch_stays_small_and_replays(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    shape = Shape.for_keys(3000, 0.01)
    new = lambda b: spark.range(b * 500, b * 500 + 500).withColumnRenamed("id", "u")
    for b in (0, 1, 2, 3, 3, 4, 5):  # batch 3 is replayed
        keyfilter.publish(spark, folder, b, new(b), "u", shape)
    size = {b: sum(os.path.getsize(os.path.join(folder, f"batch_id={b}", f))
                   for f in os.listdir(os.path.join(folder, f"batch_id={b}")) if f.endswith(".parquet")) for b in range(6)}
    assert max(size.values()) <= 2 * shape.bytes + 20_000
    last = keyfilter.published(spark, folder, 5)
    everyone = spark.range(3000).withColumnRenamed("id", "u")
    assert keyfilter.with_maybe(everyone, "u", last, shape).where("not maybe").count() == 0
    early = keyfilter.with_maybe(new(5), "u", keyfilter.published(spark, folder, 3), shape)
    assert early.where("maybe").count() <= 25  # batch 5's users are not known after batch 3
