"""A key set as a mergeable bitmap filter: who is surely not in it needs no join.

A blocked Bloom filter made of Spark's bitmap functions: a key is hashed to one
bucket of ``BUCKET_BITS`` bits and sets ``hashes`` bits there, so a lookup reads
one bitmap. The filter is a table (bucket, bitmap); two filters of one shape
merge by a bitwise or per bucket, so what is blocked in a micro-batch is added to
the filter of the batches before without reading the keys again.

A filter never says "not in the set" of a key that is in it. Of other keys it
passes about the stated rate, and those, with the true members, are verified by
a join with the set itself (``exclude``); all other rows skip that join. A shape
holds its rate up to ``capacity`` keys; a set that outgrows it needs a new shape
(``Shape.for_keys``) and a rebuilt filter, which costs rate, never rows.

The filter has ``buckets`` rows of 4 KiB, whatever the number of rows filtered.
It is broadcast while it has at most ``MAX_BROADCAST`` bytes; a larger one is
joined by bucket, and a hot bucket is then left to the skew join.
"""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BITS = 32_768  # fixed value: bits of one of Spark's bitmaps
BUCKET_BYTES = BUCKET_BITS // 8
MAX_BROADCAST = 64 << 20
SPREAD = 1.2  # more bits than an unblocked filter: buckets are not filled evenly


@dataclass(frozen=True)
class Shape:
    buckets: int
    hashes: int
    capacity: int

    @classmethod
    def for_keys(cls, keys: int, rate: float) -> "Shape":
        """The shape that passes about ``rate`` of other keys when it holds ``keys``."""
        if not 0 < rate < 1 or keys < 0:
            raise ValueError("a rate lies between 0 and 1, a number of keys is not negative")
        per_key = -math.log(rate) / math.log(2) ** 2
        bits = max(keys, 1) * per_key * SPREAD
        return cls(math.ceil(bits / BUCKET_BITS), max(1, round(per_key * math.log(2))), max(keys, 1))

    @property
    def bytes(self) -> int:
        return self.buckets * BUCKET_BYTES

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def bits(self, key: Column) -> Column:
        """The positions of a key in its bucket: steps of one hash from another."""
        first, step = F.hash(key, F.lit(1)).cast("bigint"), F.hash(key, F.lit(2)).cast("bigint")
        return F.array(*[F.pmod(first + F.lit(i) * (step * 2 + 1), F.lit(BUCKET_BITS)) for i in range(self.hashes)])


def build(keys: DataFrame, key: str, shape: Shape) -> DataFrame:
    """(bucket, bitmap) of a set of keys; a null key is not in it."""
    bits = (keys.where(F.col(key).isNotNull())
            .select(shape.bucket(F.col(key)).alias("bucket"), F.explode(shape.bits(F.col(key))).alias("bit")))
    return bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def merge(*filters: DataFrame) -> DataFrame:
    """The filter of the union of the sets; all of one shape."""
    both = filters[0]
    for f in filters[1:]:
        both = both.unionByName(f)
    return both.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def maybe(bitmap: Column, bits: Column) -> Column:
    """Whether all positions are set; a missing bitmap has none."""
    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (bit % 8).cast("int")) == 1
    return bitmap.isNotNull() & F.forall(bits, is_set)


def with_maybe(rows: DataFrame, key: str, filter_: DataFrame, shape: Shape, out: str = "maybe") -> DataFrame:
    """``rows`` with ``out``: false where the key is surely not in the set."""
    f = filter_.select(F.col("bucket").alias("__bucket"), "bitmap")
    if shape.bytes <= MAX_BROADCAST:
        f = F.broadcast(f)
    # a null key lies in some bucket, too, and is not in the set
    joined = rows.withColumn("__bucket", shape.bucket(F.col(key))).join(f, "__bucket", "left")
    found = F.col(key).isNotNull() & maybe(F.col("bitmap"), shape.bits(F.col(key)))
    return joined.withColumn(out, found).drop("__bucket", "bitmap")


def exclude(rows: DataFrame, key: str, members: DataFrame, filter_: DataFrame, shape: Shape,
            unless: Column | None = None) -> DataFrame:
    """The rows whose key is not among ``members`` (unique keys): the filter lets
    the others through and the rest is joined. With ``unless`` (over the columns of
    both) a row of a member stays where it holds. Columns of ``members`` beside the
    key must not clash with those of ``rows``."""
    marked = with_maybe(rows, key, filter_, shape, "__maybe")
    sure = marked.where(~F.col("__maybe")).select(*rows.columns)
    asked = marked.where("__maybe").select(*rows.columns)
    if unless is None:
        return sure.union(asked.join(members, key, "left_anti"))
    known = members.withColumn("__member", F.lit(True))
    stays = F.col("__member").isNull() | F.coalesce(unless, F.lit(False))
    return sure.union(asked.join(known, key, "left").where(stays).select(*rows.columns))


# --- a filter published per micro-batch ------------------------------------------------

def publish(spark: SparkSession, folder: str, batch_id: int, new_keys: DataFrame, key: str, shape: Shape) -> None:
    """The filter after batch ``batch_id``: that of the batch before with the new
    keys. A replayed batch writes the same bitmaps again."""
    fresh = build(new_keys, key, shape)
    if batch_id > 0:
        fresh = merge(published(spark, folder, batch_id - 1), fresh)
    fresh.write.mode("overwrite").parquet(os.path.join(folder, f"batch_id={batch_id}"))


def published(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    """The filter after batch ``batch_id``."""
    return spark.read.schema("bucket int, bitmap binary").parquet(os.path.join(folder, f"batch_id={batch_id}"))
