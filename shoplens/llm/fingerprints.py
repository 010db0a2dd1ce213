"""Document fingerprints: SimHash over weighted word pairs, and the permuted-block search.

Every adjacent word pair (a text of one word: the word) is a term. Its XXH64
is widened to 256 bits, and each bit votes +w or -w with the term's weight w:
1 + log2 of its occurrences, times 1 to 4 by the pair's length, so repeated
terms and short function words count less. A bit of the fingerprint is 1 where the votes are positive.
Equal texts have equal fingerprints; a text without words has fingerprint 0.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import WordHasher, map_arrow, mix, read, schema_with, staged, text_batches, word_hashes

BITS = 256
# the search: differing bits of two fingerprints whose terms' weights have a cosine c are about BITS * acos(c) / pi,
# so 7 bits are a cosine of 0.996; 8 blocks of 32 bits then make 8 tables, each led by another block
RADIUS, BLOCKS = 7, 8
_TERMS_AT_ONCE = 512  # their unpacked bits stay in a core's cache
_HASHER = WordHasher()


def _weights(lengths: np.ndarray) -> np.ndarray:
    return np.clip(lengths // 5, 1, 4).astype(np.float32)


def simhash(texts: list[bytes]) -> list[bytes]:
    """One 32-byte fingerprint per text."""
    h, lens, first = word_hashes(texts, _HASHER)
    n = len(h)
    if n == 0:
        return [bytes(BITS // 8)] * len(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    # a term starts at every word that has a next one in its text, or is the only one
    start = np.ones(n, dtype=bool)
    start[first[1:][np.diff(first) > 1] - 1] = False
    at = np.flatnonzero(start)
    alone = (np.diff(first) == 1)[doc[at]]
    second = np.where(alone, at, at + 1)
    with np.errstate(over="ignore"):
        term = mix(h[at], 1) * np.uint64(3) + np.where(alone, np.uint64(0), mix(h[second], 2))
    weight = _weights(lens[at] + np.where(alone, 0, lens[second]))
    ends = np.searchsorted(at, first)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        terms, where, times = np.unique(term[a:b], return_index=True, return_counts=True)
        w = weight[a:b][where] * (1 + np.log2(times)).astype(np.float32)
        wide = np.stack([mix(terms, k) for k in range(3, 3 + BITS // 64)], axis=1).view(np.uint8)
        votes = np.full(BITS, -w.sum(dtype=np.float64) / 2)
        for i in range(0, len(terms), _TERMS_AT_ONCE):
            votes += (w[i:i + _TERMS_AT_ONCE]
                      @ np.unpackbits(wide[i:i + _TERMS_AT_ONCE], axis=1).astype(np.float32))
        out.append(np.packbits(votes > 0).tobytes())
    return out


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint (32 bytes, binary) of column ``text`` as ``out``."""
    schema = schema_with(df, **{out: "binary"})
    where = df.columns.index(text)

    def run(batches):
        for b, texts in text_batches(batches, where):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(simhash(texts), pa.binary())],
                                             names=[*b.schema.names, out])

    return map_arrow(df, run, schema)


def likeness(a, b):
    """1 - (differing bits / bits) of two fingerprint columns, by 64-bit words."""
    differ = F.lit(0)
    for k in range(BITS // 64):
        word = [F.conv(F.hex(F.substring(x, 8 * k + 1, 8)), 16, -10).cast("long") for x in (a, b)]
        differ = differ + F.bit_count(word[0].bitwiseXOR(word[1]))
    return 1.0 - differ / F.lit(float(BITS))


def bin_visits(bins: DataFrame) -> DataFrame:
    """(__top, __own, __to) of a (__bin, __top) table: the bin that the first row
    of each bin visits, which is the one before it in descending order (nulls
    last), and for the first bin the last one.

    The bins may be as many as the keys are sparse, so they are sorted into
    range parts; a window inside each part finds the bin before, and only the
    parts' ends (a row per shuffle partition) are ordered as a whole. The parts
    are stored, so every later read sees the same ones.
    """
    order = F.col("__bin").desc_nulls_last()
    parts = staged(bins.sparkSession, bins.orderBy(order).withColumn("__part", F.spark_partition_id()), "bins")
    inside = Window.partitionBy("__part").orderBy(order)
    placed = (parts.withColumn("__nth", F.row_number().over(inside))
              .withColumn("__before", F.lag("__bin").over(inside))
              .withColumn("__more", F.lead(F.lit(True)).over(inside)))
    whole = Window.orderBy("__part")
    every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = placed.where("__more is null").select(
        "__part", F.when(F.row_number().over(whole) > 1, F.lag("__bin").over(whole))
        .otherwise(F.last("__bin").over(every)).alias("__end"))
    return placed.join(F.broadcast(ends), "__part").select(
        "__top", F.col("__bin").alias("__own"),
        F.when(F.col("__nth") > 1, F.col("__before")).otherwise(F.col("__end")).alias("__to"))


def with_next(df: DataFrame, key: str, carried: list[str], prefix: str = "next_",
              span_bits: int = 11, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` with the ``carried`` columns of the row that follows in descending
    ``key`` (nulls last; after the last row: the first), without one task that
    sees all rows.

    Keys are binned by ``key >> span_bits``, so a bin holds at most 2**span_bits
    different keys. Each bin is sorted in its own window; its last row is
    followed by a visiting copy of the first row of the next bin (see
    ``bin_visits``). Rows with equal keys follow each other by the hash of the
    carried columns and stay in one bin, as do rows without a key: ``key`` is to
    be an identifier. ``prepare`` adds columns to rows and visitors before they
    are dealt, so costly ones are made once.
    """
    keyed = df.withColumn("__bin", F.shiftright(F.col(key).cast("long"), span_bits))
    # (stored: by its file size Spark sees beforehand whether this table can be broadcast)
    visits = staged(df.sparkSession, bin_visits(keyed.groupBy("__bin").agg(F.max(key).alias("__top"))), "visits")
    guests = (keyed.withColumnRenamed("__bin", "__home")
              .join(visits, F.col("__home").eqNullSafe(F.col("__own"))
                    & F.col(key).eqNullSafe(F.col("__top")))
              .withColumnRenamed("__to", "__bin")
              .select(*keyed.columns).withColumn("__guest", F.lit(1)))
    rows = keyed.withColumn("__guest", F.lit(0)).unionByName(guests)
    rows = prepare(rows) if prepare else rows
    order = Window.partitionBy("__bin").orderBy(
        "__guest", F.col(key).desc_nulls_last(), F.xxhash64(*carried))
    for c in carried:
        rows = rows.withColumn(prefix + c, F.lead(c).over(order))
    return rows.where("__guest = 0").drop("__bin", "__guest")


def block_keys(fps: DataFrame, radius: int, blocks: int, column: str = "fingerprint") -> DataFrame:
    """One row per (fingerprint, table): the permuted prefix of ``blocks - radius``
    blocks that two fingerprints within ``radius`` bits must share in some table."""
    if BITS % blocks or (BITS // blocks) % 8 or blocks <= radius:
        raise ValueError("blocks must split the fingerprint into whole bytes and exceed the radius")
    width = BITS // blocks // 8
    tables = [F.struct(F.lit(t).alias("table"),
                       F.xxhash64(F.lit(t), *[F.substring(F.col(column), b * width + 1, width)
                                              for b in kept]).alias("prefix"))
              for t, kept in enumerate(combinations(range(blocks), blocks - radius))]
    return fps.select(column, F.explode(F.array(*tables)).alias("k")).select(column, "k.*")


def _words(fingerprint) -> list:
    """The 64-bit words of a fingerprint column, as longs."""
    return [F.conv(F.hex(F.substring(fingerprint, 8 * k + 1, 8)), 16, -10).cast("long") for k in range(BITS // 64)]


def _first_table(table, differ: list, radius: int, blocks: int):
    """Column: ``table`` is the first one whose kept blocks are all without a
    differing bit (``differ``: the words of a XOR b), so a pair counts once."""
    width = BITS // blocks

    def same(block: int):
        at, size = divmod(block * width, 64)
        if width >= 64:
            return F.greatest(*[differ[at + i] != 0 for i in range(width // 64)], F.lit(False)) == F.lit(False)
        mask = (1 << width) - 1
        return F.shiftrightunsigned(differ[at], 64 - width - size).bitwiseAND(F.lit(mask)) == 0

    first = F.lit(False)
    for t, kept in enumerate(combinations(range(blocks), blocks - radius)):
        clear = table == t
        for block in range(kept[-1]):
            if block not in kept:
                clear = clear & ~same(block)
        first = first | clear
    return first


def near_words(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, column: str = "fingerprint") -> DataFrame:
    """All pairs (a < b as words, bits) of different fingerprints within ``radius``
    bits; a and b are structs of 64-bit words. Copies and nulls are taken out first;
    candidates meet in a block table on the whole permuted prefix, are verified bit
    by bit in the join, and count in their first common table only, so nothing is
    shuffled after the join. Complete for every radius below ``blocks`` (pigeonhole)."""
    keys = block_keys(fps.select(column).where(F.col(column).isNotNull()).distinct(), radius, blocks, column)
    names = [f"w{k}" for k in range(BITS // 64)]
    sides = keys.select("table", "prefix", *[w.alias(n) for w, n in zip(_words(F.col(column)), names)])
    x, y = sides.alias("x"), sides.alias("y")
    a, b = (F.struct(*[F.col(f"{side}.{n}").alias(n) for n in names]) for side in "xy")
    differ = [F.col(f"x.{n}").bitwiseXOR(F.col(f"y.{n}")) for n in names]
    bits = sum((F.bit_count(d) for d in differ), F.lit(0))
    meet = (F.col("x.table") == F.col("y.table")) & (F.col("x.prefix") == F.col("y.prefix"))
    near = (a < b) & (bits <= radius) & _first_table(F.col("x.table"), differ, radius, blocks)
    return x.join(y, meet).where(near).select(a.alias("a"), b.alias("b"), bits.cast("int").alias("bits"))


def _joined(words):
    """The binary fingerprint of a struct of words."""
    return F.concat(*[F.unhex(F.lpad(F.hex(words[f"w{k}"]), 16, "0")) for k in range(BITS // 64)])


def near_fingerprints(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
                      column: str = "fingerprint") -> DataFrame:
    """``near_words`` with the fingerprints as binary columns a < b (bytewise)."""
    x, y = _joined(F.col("a")), _joined(F.col("b"))
    pairs = near_words(fps, radius, blocks, column).select(x.alias("x"), y.alias("y"), "bits")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "bits")


def near_counts(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, column: str = "fingerprint") -> DataFrame:
    """(column, near): how many other fingerprints lie within ``radius`` bits, for
    those that have one. Counted per task before the shuffle: no pair is written."""
    ends = near_words(fps, radius, blocks, column).select(F.explode(F.array("a", "b")).alias("at"))
    return (ends.groupBy("at").agg(F.count(F.lit(1)).alias("near"))
            .select(_joined(F.col("at")).alias(column), "near"))


def op1_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its text with the last half replaced
    by the next document's beginning, with the likenesses and the number of other
    fingerprints of the table within RADIUS bits. Null texts read as empty; with
    one document the next is itself; repeated rows each give a row."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", ["text", "fp"],
                     prepare=lambda d: with_fingerprint(d, "text", "fp"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp",
                       edited.alias("edited"))
    rows = with_fingerprint(rows, "edited", "edited_fp")
    found = staged(spark, rows.select("doc_id", "n_chars", F.unhex(F.sha2("edited", 256)).alias("edited_sha256"),
                                      "fp", "edited_fp", likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                                      likeness(F.col("fp"), F.col("next_fp")).alias("near_next")), "found")
    # (stored: by its file size Spark sees beforehand whether this table can be broadcast)
    near = staged(spark, near_counts(found, column="fp"), "near")
    return found.join(near, "fp", "left").select(
        "doc_id", "n_chars", *[F.lower(F.hex(c)).alias(name) for c, name in (
            ("edited_sha256", "edited_sha256"), ("fp", "fingerprint"), ("edited_fp", "edited_fingerprint"))],
        "near_edited", "near_next", F.coalesce("near", F.lit(0)).alias("near_fingerprints"))
