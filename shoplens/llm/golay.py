"""SimHash near-dedup with Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments A (23 bits), B (23) and R (18,
padded with zeros to 23). Every 23-bit vector lies within 3 bits of exactly one
codeword of the binary Golay code and within 4 bits of one or six; K(x) is the
set of those codewords' 12-bit indices. Vectors at most 2 bits apart share an
index in K. Pigeonhole for two fingerprints at most 4 bits apart, with a, b, r
differing bits in the segments:

  r = 0:            min(a, b) <= 2   keys (R, K(A)) and (R, K(B))
  a = 0:            min(b, r) <= 2   keys (A, K(B)) and (A, K(R))
  b = 0:            min(a, r) <= 2   keys (B, K(A)) and (B, K(R))
  a, b, r >= 1:     a, b, r <= 2     keys (K(A), K(B), third of R) - r <= 2 bits
                                     leave one of R's three 6-bit parts alike

so they share a key. A pair is accepted only under the first family that its
segment distances name, after all 64 bits are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import map_arrow, read, schema_with, staged, text_batches

SHINGLE = 4
MAX_BITS = 4
SEED = 42
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
FOREST_NODES = 1_000_000  # fingerprints whose classes a task remembers while it thins its links
HOT_SHARE = 1000  # a class with more than one in so many fingerprints is hot: there are fewer such classes
MASK_A, MASK_B, MASK_R = ((1 << 23) - 1) << 41, ((1 << 23) - 1) << 18, (1 << 18) - 1


def parity(data: int) -> int:
    """The 11 check bits of a 12-bit datum."""
    rest = data << 11
    for bit in range(22, 10, -1):
        if rest >> bit & 1:
            rest ^= GENERATOR << (bit - 11)
    return rest


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Check bits by datum; by syndrome: up to six error patterns of weight <= 4, and how many."""
    checks = np.array([parity(d) for d in range(1 << 12)], dtype=np.uint32)
    errors: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for at in combinations(range(23), weight):
            e = sum(1 << i for i in at)
            errors[int(checks[e >> 11]) ^ (e & 2047)].append(e)
    table = np.zeros((1 << 11, 6), dtype=np.uint32)
    for s, es in enumerate(errors):
        table[s, :len(es)] = es
    return checks, table, np.array([len(es) for es in errors])


CHECKS, ERRORS, N_ERRORS = _tables()


def golay_keys(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) codeword indices within 4 bits of each 23-bit vector, and which are set."""
    segment = segment.astype(np.uint32)
    syndrome = CHECKS[segment >> 11] ^ (segment & 2047)
    keys = (segment[:, None] ^ ERRORS[syndrome]) >> 11
    return keys.astype(np.int64), np.arange(6)[None, :] < N_ERRORS[syndrome][:, None]


def candidate_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``fps``, key): family in the bits from 56 on, the parts below."""
    u = fps.view(np.uint64)
    a = (u >> np.uint64(41)).astype(np.int64)
    b = (u >> np.uint64(18) & np.uint64(MASK_B >> 18)).astype(np.int64)
    r = (u & np.uint64(MASK_R)).astype(np.int64)
    (ka, ha), (kb, hb), (kr, hr) = map(golay_keys, (a, b, r))
    rows, keys = [], []

    def put(family: int, key: np.ndarray, have: np.ndarray) -> None:
        at = np.nonzero(have)
        rows.append(at[0])
        keys.append(key[at] | family << 56)

    for family, (exact, k, h) in enumerate([(r, ka, ha), (r, kb, hb), (a, kb, hb), (a, kr, hr),
                                            (b, ka, ha), (b, kr, hr)]):
        put(family, exact[:, None] << 12 | k, h)
    both = (ka[:, :, None] << 12 | kb[:, None, :]).reshape(len(u), 36)
    have = (ha[:, :, None] & hb[:, None, :]).reshape(len(u), 36)
    for part in range(3):
        put(6 + part, both << 6 | (r >> 6 * part & 63)[:, None], have)
    return np.concatenate(rows), np.concatenate(keys)


def family_of(x: Column) -> Column:
    """The first family under which a pair with differing bits ``x`` is accepted."""
    def bits(mask: int) -> Column:
        return F.bit_count(x.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)))

    ea, eb, er = bits(MASK_A), bits(MASK_B), bits(MASK_R)
    return (F.when(er == 0, F.when(ea <= 2, 0).otherwise(1))
            .when(ea == 0, F.when(eb <= 2, 2).otherwise(3))
            .when(eb == 0, F.when(ea <= 2, 4).otherwise(5))
            .when(bits(63) == 0, 6).when(bits(63 << 6) == 0, 7).otherwise(8))


def simhash64(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of every word shingle of a whole text; 0 without words."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII spaces part words
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lens = np.fromiter(map(len, words), np.int64, n)
    starts = np.cumsum(lens + 1) - lens - 1
    hashes = np.fromiter(
        [xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in
         zip(starts.tolist(), (starts + lens)[shingle - 1:].tolist())], np.uint64, n - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[i:i + 4096].astype(">u8").view(np.uint8).reshape(-1, 8),
                              axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def with_simhash(df: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``df`` without ``text``, with the fingerprint as a (signed) long."""
    where = df.columns.index(text)
    rest = df.drop(text)
    names = [*rest.columns, out]

    def run(batches):
        for b, texts in text_batches(batches, where):
            fps = np.array([simhash64(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            others = [c for i, c in enumerate(b.columns) if i != where]
            yield pa.RecordBatch.from_arrays([*others, pa.array(fps)], names=names)

    return map_arrow(df, run, schema_with(rest, **{out: "long"}))


def near_pairs(fps: DataFrame) -> DataFrame:
    """Pairs (a < b) of different fingerprints at most 4 bits apart; ``fps`` has
    each fingerprint once in its only column. A pair may come more than once.
    The keys are sorted and merged whatever their estimate, which knows the rows of
    ``fps`` but not that each gives about 117 keys: a small table would be broadcast."""
    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fp), 2048):
                rows, keys = candidate_keys(fp[i:i + 2048])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(fp[i:i + 2048][rows])], names=["key", "fp"])

    keys = map_arrow(fps, run, "key long, fp long")
    a, b = keys.select("key", F.col("fp").alias("a")), keys.select("key", F.col("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    return (a.hint("merge").join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b"))
                                 & (F.bit_count(x) <= MAX_BITS)
                                 & (F.shiftright(a["key"], 56) == family_of(x)))
            .select("a", "b"))


def forest(pairs: Iterator[tuple[int, int]], limit: int = FOREST_NODES) -> Iterator[tuple[int, int]]:
    """The pairs that join two classes not yet joined by earlier ones: a spanning
    forest, fewer than one pair per node. Past ``limit`` nodes the memory starts
    afresh, which leaves more pairs in but never loses a class."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        if len(parent) > limit:
            parent.clear()
        a_top, b_top = root(a), root(b)
        if a_top != b_top:
            parent[max(a_top, b_top)] = min(a_top, b_top)
            yield a, b


def thinned(pairs: DataFrame) -> DataFrame:
    """(a, b) links with the same classes as ``pairs``, a spanning forest of what
    each task verifies: a dense class of n members writes at most n - 1 links a
    task, not the square of n."""
    def run(batches):
        # batch by batch, so the verified pairs themselves are never held
        for part in _chunks(forest((a, b) for batch in batches for a, b in
                                   zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))):
            a, b = zip(*part)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return map_arrow(pairs.select("a", "b"), run, "a long, b long")


def _chunks(rows: Iterator[tuple], size: int = 10_000) -> Iterator[list[tuple]]:
    while part := list(islice(rows, size)):
        yield part


def components(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """(node, label) for every node of ``pairs`` but the labels themselves: the
    smallest node reachable. Large-star and small-star steps in turn, each round
    written to the shared folder, until the edges stay the same."""
    edges = staged(spark, pairs.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                   .distinct(), "links")
    known = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(mark) == known:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
        known = tuple(mark)
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(lowest, "hi").where("lo <> m")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(lowest.select("hi", "m")).distinct())
        edges = staged(spark, small, "links")


def classes(spark: SparkSession, fingerprints: DataFrame, key: str = "doc_id") -> DataFrame:
    """(fp, label, component_id) for every different fingerprint of a stored
    (key, fp) table: the smallest fingerprint and the smallest key reachable
    over links of at most 4 bits; the key is null only where none is set. Rows
    of hot classes (at most HOT_SHARE of them) get their class's key by
    broadcast, so no class is dealt to one task."""
    reps = staged(spark, fingerprints.groupBy("fp").agg(F.min(key).alias("rep")), "fingerprints")
    links = components(spark, thinned(near_pairs(reps.select("fp"))))
    labelled = staged(spark, reps.join(links, reps["fp"] == links["node"], "left")
                      .select("fp", "rep", F.coalesce("label", "fp").alias("label")), "labels")
    best = labelled.groupBy("label").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("members"))
    total = labelled.agg(F.count(F.lit(1))).scalar()
    is_hot = F.col("members") * HOT_SHARE > total
    best = staged(spark, best, "classes")
    hot, other = (best.where(x).drop("members") for x in (is_hot, ~is_hot))
    names = ["fp", "label", "component_id"]
    of_hot = labelled.join(F.broadcast(hot), "label").select(*names)
    rest = labelled.join(F.broadcast(hot.select("label")), "label", "left_anti")
    return of_hot.unionByName(rest.join(other, "label").select(*names))


def near_duplicates(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, label, component_id), a row per row of ``docs``. Null texts read as
    empty (fingerprint 0, linked like any other); repeated rows stay repeated."""
    fps = staged(spark, with_simhash(docs.select(F.col(key).alias(key), F.col(text).alias("__text")),
                                     "__text"), "simhash")
    return fps.join(classes(spark, fps, key), "fp").select(key, "fp", "label", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies, the row with the smallest
    doc_id (rows without one last), then the least text hash. Rows equal in both
    are interchangeable. A doc_id with unrelated texts keeps a row in each group."""
    marks = {"__mark": F.xxhash64("text"), "__check": F.xxhash64(F.lit(1), "text")}
    rows = docs.withColumns(marks)
    fps = staged(spark, with_simhash(rows.select("doc_id", *marks, F.col("text").alias("__text")), "__text"),
                 "simhash")
    first = F.struct(F.isnull("doc_id").alias("__unnamed"), F.col("doc_id").alias("__id"),
                     *[F.col(m).alias(m + "_of") for m in marks])
    firsts = fps.groupBy("fp").agg(F.min(first).alias("__first"))
    chosen = (firsts.join(classes(spark, fps), "fp").groupBy("label")
              .agg(F.min("__first").alias("__first")).select("__first.*").drop("__unnamed"))
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    for m in marks:
        same = same & (F.col(m) == F.col(m + "_of"))
    nth = Window.partitionBy("doc_id", *marks).orderBy("__mark")
    return (rows.join(chosen, same, "left_semi")
            .withColumn("__nth", F.row_number().over(nth)).where("__nth = 1").select(*docs.columns))


def op5_golay_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy classes of all documents: 4-word shingles, links up to 4 bits."""
    found = near_duplicates(spark, read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
