"""Hard-negative mining by a secondary-sort shuffle of packed pair scores.

Vectors are packed into blocks of rows. The anchors (the stated query set) of
every block meet all blocks through an equi-join on a dealt block number, and a
pair of blocks is scored at once by a matrix product inside a task. Twice:

1. positives: a task keeps, per anchor and block, the first ``positives`` rows
   of the anchor's label; the shuffle then gives each anchor's first ones;
2. negatives: with the positive scores known, a task keeps, per anchor, window
   and block, the first ``negatives`` rows of another label inside the window.
   The first ones of all rows are among the first ones of the blocks, so
   nothing is lost and what is shuffled does not grow with the block.

Scores are packed into one binary key (anchor, descending score, kind, id). The
rows are repartitioned by anchor and sorted within the partitions by that key;
an iterator over the sorted stream opens a window when a positive comes, emits
the negatives that fall into open windows, and holds the open windows of one
anchor and nothing else.

Nulls and ties: a row without a label or vector, or with a null or non-finite
component, takes no part, nor does one without an id, which no result could
name. Equal scores are ordered by id. Rows repeated under one id are rows of
their own: each is ranked, each anchor row gives its rows, and a row is never
its own id's positive. A vector with fewer components than another has zeros for the missing
ones. A component times the scale is held within 64 bits, as is a score.
Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import map_arrow, read, staged

ROWS = 16_384           # rows of a block
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH, WHOLE = 30, 90, 100  # LOW * positive <= WHOLE * negative <= HIGH * positive
MAX_TASKS = 20_000
INT64 = (-(2**63), 2**63 - 1)
BLOCK_SCHEMA = "block long, n int, dim int, width int, ids binary, labels binary, vectors binary"
# anchor id, its row, inverted score, kind (0 positive, 1 negative), id; big-endian, so bytes sort as numbers
KEY = np.dtype([("id", ">u8"), ("row", ">u8"), ("score", ">u8"), ("kind", "u1"), ("other", ">u8")])


def quantised(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as integers, the ends of 64 bits for what lies beyond."""
    with np.errstate(over="ignore"):
        x = np.floor(values * scale)
    inside = np.clip(x, -(2.0**63), 2.0**62)
    out = inside.astype(np.int64)
    big = x > 2.0**62
    if big.any():
        out[big] = [min(int(v), INT64[1]) if np.isfinite(v) else INT64[1] for v in x[big]]
    return out


def narrowest(x: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes that hold them."""
    top = max((abs(int(x.min())), abs(int(x.max()))), default=0) if x.size else 0
    return x.astype("<i2" if top < 2**15 else "<i4" if top < 2**31 else "<i8")


def pack_blocks(batches, rows: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ``rows`` valid rows (id, label, vector), sorted by id."""
    part, seq = TaskContext.get().partitionId(), 0
    held: list[tuple[np.ndarray, np.ndarray, list]] = []
    count = 0

    def flush():
        nonlocal held, count, seq
        ids, labels = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        dim = max(m.shape[1] for h in held for _, m in h[2])
        x = np.zeros((len(ids), dim), dtype=np.int64)
        base = 0
        for h in held:
            for at, m in h[2]:
                x[base + at, :m.shape[1]] = m
            base += len(h[0])
        order = np.argsort(ids, kind="stable")
        small = narrowest(x[order])
        out = pa.RecordBatch.from_pydict({
            "block": pa.array([seq << 24 | part], pa.int64()), "n": pa.array([len(ids)], pa.int32()),
            "dim": pa.array([dim], pa.int32()), "width": pa.array([small.itemsize], pa.int32()),
            "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
            "labels": pa.array([labels[order].astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([small.tobytes()], pa.binary())})
        held, count, seq = [], 0, seq + 1
        return out

    for b in batches:
        for a in range(0, b.num_rows, rows):
            ids, labels, parts = valid_rows(b.slice(a, rows), scale)
            if len(ids) == 0:
                continue
            if count + len(ids) > rows:
                yield flush()
            held.append((ids, labels, parts))
            count += len(ids)
    if held:
        yield flush()


def valid_rows(b: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray, list]:
    """ids and labels of the rows that take part, and their quantised vectors as
    (rows among them, matrix) for each length that occurs."""
    vectors = b.column(2)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null is NaN
    lens = np.array([-1 if x is None else x for x in pc.list_value_length(vectors).to_pylist()], np.int64)
    starts = np.concatenate([[0], np.cumsum(np.maximum(lens, 0))])
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ok = ((lens >= 0) & (wrong[starts[1:]] == wrong[starts[:-1]])
          & ~b.column(0).is_null().to_numpy(zero_copy_only=False)
          & ~b.column(1).is_null().to_numpy(zero_copy_only=False))
    keep = pa.array(ok)
    ids, labels = (b.column(k).filter(keep).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
    starts, lens = starts[:-1][ok], lens[ok]
    parts = []
    for n in np.unique(lens):
        at = np.flatnonzero(lens == n)
        where = starts[at][:, None] + np.arange(n)
        parts.append((at, quantised(values[where], scale)))
    return ids, labels, parts


def matrix(vectors: bytes, n: int, dim: int, width: int) -> np.ndarray:
    return np.frombuffer(vectors, dtype=f"<i{width}", count=n * dim).reshape(n, dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` with all rows of ``b``:
    by floating point while no partial sum can reach 2**53, else by integers."""
    dim = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, dim - m.shape[1]))) if m.shape[1] < dim else m for m in (a, b))
    most = [max((abs(int(m.min())), abs(int(m.max())))) if m.size else 0 for m in (a, b)]
    bound = most[0] * most[1] * max(dim, 1)
    if bound < 2**24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, *INT64).astype(np.int64)


def first(scores: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Of ``rows`` (ascending, as their ids), the k with the highest scores; equal scores by id."""
    if len(rows) <= k:
        return rows
    s = scores[rows]
    least = np.partition(s, len(s) - k)[len(s) - k]
    above = rows[s > least]
    return np.concatenate([above, rows[s == least][:k - len(above)]])


def window(positive: int) -> tuple[int, int]:
    """The least and the greatest negative score inside the window of a positive score."""
    return -(-LOW * positive // WHOLE), HIGH * positive // WHOLE


def packed(parts: list[tuple[int, int, np.ndarray, int, np.ndarray]]) -> pa.Array:
    """Keys of (anchor id, anchor row, scores, kind, other ids) runs as a binary array."""
    n = sum(len(p[2]) for p in parts)
    keys = np.empty(n, dtype=KEY)
    at = 0
    for anchor, row, scores, kind, others in parts:
        k = keys[at:at + len(scores)]
        k["id"], k["row"], k["kind"] = anchor + 2**63, row, kind
        k["score"] = np.uint64(2**63 - 1) - scores.view(np.uint64)  # modulo 2**64, so exact
        k["other"] = others.view(np.uint64) ^ np.uint64(2**63)
        at += len(scores)
    offsets = np.arange(0, (n + 1) * KEY.itemsize, KEY.itemsize, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(keys.tobytes())])


def unpacked(column: pa.Array) -> np.ndarray:
    """The keys of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=KEY)


def numbers(keys: np.ndarray) -> tuple[list[int], list[int], list[int], list[int], list[int]]:
    """(anchor id, anchor row, score, kind, other id) as lists of Python integers."""
    flip = np.uint64(2**63)
    signed = [(keys[c].astype(np.uint64) ^ flip).view(np.int64).tolist() for c in ("id", "other")]
    score = (np.uint64(2**63 - 1) - keys["score"].astype(np.uint64)).view(np.int64).tolist()
    return signed[0], keys["row"].tolist(), score, keys["kind"].tolist(), signed[1]


def pair_keys(batches, positives: int, negatives: int) -> Iterator[pa.RecordBatch]:
    """Keys of joined blocks (a_*: the anchors' block, b_*: the block they are
    scored against). Without ``wins``: the first positives; with it (anchor row
    and positive (id, score) of each window, and whether this block tells the
    positives): the first negatives of each window."""
    for b in batches:
        for r in b.to_pylist():
            ids, labels = (np.frombuffer(r[k], "<i8") for k in ("b_ids", "b_labels"))
            a_ids, a_labels = (np.frombuffer(r[k], "<i8") for k in ("a_ids", "a_labels"))
            scores = products(matrix(r["a_vectors"], len(a_ids), r["a_dim"], r["a_width"]),
                              matrix(r["b_vectors"], len(ids), r["b_dim"], r["b_width"]))
            parts = []
            if "wins" not in r:
                same = {x: np.flatnonzero(labels == x) for x in np.unique(a_labels).tolist()}
                for i, s in enumerate(scores):
                    rows = same[int(a_labels[i])]
                    best = first(s, rows[ids[rows] != a_ids[i]], positives)
                    parts.append((int(a_ids[i]), r["a_block"] << 16 | i, s[best], 0, ids[best]))
            else:
                other = {x: labels != x for x in np.unique(a_labels).tolist()}
                open_: dict[int, list] = {}
                for w in r["wins"] or []:
                    open_.setdefault(w["row"] & 0xFFFF, []).append((w["score"], w["id"]))
                for i, wins in open_.items():
                    s, allowed = scores[i], other[int(a_labels[i])]
                    found = []
                    for low, high in {window(p) for p, _ in wins}:
                        if low <= high:
                            found.append(first(s, np.flatnonzero((s >= low) & (s <= high) & allowed), negatives))
                    row = r["a_block"] << 16 | i
                    if found:
                        best = np.unique(np.concatenate(found))
                        parts.append((int(a_ids[i]), row, s[best], 1, ids[best]))
                    if r["tells"]:
                        parts.append((int(a_ids[i]), row, np.array([p for p, _ in wins], np.int64), 0,
                                      np.array([x for _, x in wins], np.int64)))
            if parts:
                yield pa.RecordBatch.from_arrays([packed(parts)], names=["key"])


def first_positives(batches, positives: int) -> Iterator[pa.RecordBatch]:
    """The first keys of each anchor row of a sorted stream."""
    at, n = None, 0
    for b in batches:
        out = []
        for x in zip(*numbers(unpacked(b.column(0)))):
            if x[1] != at:
                at, n = x[1], 0
            n += 1
            if n <= positives:
                out.append((x[1] >> 16, x[1], x[2], x[4]))
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(4)],
                                         names=["block", "row", "score", "id"])


def emitted(batches, negatives: int) -> Iterator[pa.RecordBatch]:
    """The streaming pass over sorted keys: a positive opens a window, a negative
    goes to the open windows it lies in that are not full yet."""
    at, windows = None, []  # windows: [positive id, positive score, low, high, emitted]
    for b in batches:
        out: list[tuple] = []
        for anchor, row, score, kind, other in zip(*numbers(unpacked(b.column(0)))):
            if row != at:
                at, windows = row, []
            if kind == 0:
                windows.append([other, score, *window(score), 0])
                continue
            for w in windows:
                if w[2] <= score <= w[3] and w[4] < negatives:
                    w[4] += 1
                    out.append((anchor, w[0], w[4], other, w[1], score))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)],
            names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])


def secondary_sort(keys: DataFrame, tasks: int) -> DataFrame:
    """Keys of one anchor in one partition, each partition sorted by the whole key."""
    return keys.repartition(tasks, F.substring("key", 1, 16)).sortWithinPartitions("key")


def meet(anchors: DataFrame, blocks: DataFrame, buckets: int, tasks: int) -> DataFrame:
    """Every anchors' block beside every block: an equi-join on the bucket a block is dealt to."""
    dealt = F.pmod(F.xxhash64("block"), F.lit(buckets)).cast("int")
    a = (anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
         .repartition(tasks, "bucket"))
    b = (blocks.select(dealt.alias("bucket"), *[F.col(c).alias(f"b_{c}") for c in blocks.columns])
         .repartition(tasks, "bucket"))
    return a.join(b, "bucket").drop("bucket")


def hard_negatives(spark: SparkSession, vectors: DataFrame, every: int, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, scale: int = SCALE, rows: int = ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    of vectors (id, label, vector in this order): anchors are the rows whose id is
    divisible by ``every``."""
    if not 0 < rows <= 1 << 16:
        raise ValueError("a block has 1 to 65,536 rows")
    blocks = staged(spark, map_arrow(vectors, lambda x: pack_blocks(x, rows, scale), BLOCK_SCHEMA), "blocks")

    def take_anchors(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = np.frombuffer(r["ids"], "<i8")
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    m = matrix(r["vectors"], len(ids), r["dim"], r["width"])[at]
                    yield pa.RecordBatch.from_pydict({
                        "a_block": pa.array([r["block"]], pa.int64()), "a_dim": pa.array([r["dim"]], pa.int32()),
                        "a_width": pa.array([r["width"]], pa.int32()),
                        "a_ids": pa.array([ids[at].tobytes()], pa.binary()),
                        "a_labels": pa.array([np.frombuffer(r["labels"], "<i8")[at].tobytes()], pa.binary()),
                        "a_vectors": pa.array([np.ascontiguousarray(m).tobytes()], pa.binary())})

    anchors = staged(spark, map_arrow(blocks, take_anchors, "a_block long, a_dim int, a_width int, a_ids binary, "
                                      "a_labels binary, a_vectors binary"), "anchors")
    n = blocks.count()
    buckets, tasks = max(n, 1), min(max(4 * n, 1), MAX_TASKS)
    keys = map_arrow(meet(anchors, blocks, buckets, tasks),
                     lambda x: pair_keys(x, positives, negatives), "key binary")
    best = staged(spark, map_arrow(secondary_sort(keys, tasks), lambda x: first_positives(x, positives),
                                   "block long, row long, score long, id long"), "positives")
    # at most ``positives`` windows for each anchor of a block
    wins = best.groupBy("block").agg(F.collect_list(F.struct("row", "score", "id")).alias("wins"))
    known = anchors.join(wins, anchors["a_block"] == wins["block"]).drop("block")
    told = blocks.agg(F.min("block")).first()[0]
    pairs = meet(known, blocks, buckets, tasks).withColumn("tells", F.col("b_block") == F.lit(told))
    keys = map_arrow(pairs, lambda x: pair_keys(x, positives, negatives), "key binary")
    return map_arrow(secondary_sort(keys, tasks), lambda x: emitted(x, negatives),
                     "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                     "negative_score long")


def op12_secondary_sort_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), moved.alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"))
    return hard_negatives(spark, vectors, 100)
