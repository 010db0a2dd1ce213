"""Helpers shared by the corpus operators: table reads, staged tables, text slices, word hashes, distributed ranks."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from shoplens.session import shared_dir

SLICE_BYTES = 1 << 20  # text handled at once inside a task; a longer text is one slice of its own


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back, so an
    expensive step is neither repeated by later uses nor lost with an executor.
    The folder belongs to the checkpoint folder's clean-up, like checkpoints."""
    path = os.path.join(shared_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def schema_with(df: DataFrame, **columns: str) -> StructType:
    """A copy of the frame's schema with more columns (name=type)."""
    schema = StructType(list(df.schema.fields))
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null reads as the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) runs of at most ``limit`` bytes, at least one text each."""
    n = len(column)
    if n == 0:
        return
    sizes = np.array([0 if x is None else x for x in
                      pc.binary_length(column).to_pylist()], dtype=np.int64)
    group = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), n]
    for a, b in zip(cuts, cuts[1:]):
        yield a, as_bytes(column.slice(a, b - a))


def text_batches(batches, where: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches cut by ``text_slices`` of column ``where``, each with its texts;
    what a task holds and gives back at once is then bounded by its longest text."""
    for b in batches:
        for a, texts in text_slices(b.column(where)):
            yield b.slice(a, len(texts)), texts


class WordHasher(dict):
    """XXH64 of a word as a lookup; remembers at most ``limit`` words, hashes the others anew."""

    def __init__(self, seed: int = 0, limit: int = 200_000):
        super().__init__()
        self.seed, self.limit = seed, limit

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, self.seed)
        if len(self) < self.limit:
            self[word] = h
        return h


def word_hashes(texts: list[bytes], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, its length in bytes, first word of each text with the total at the end)."""
    words = [t.split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = [w for ws in words for w in ws]
    h = np.fromiter(map(hasher.__getitem__, flat), np.uint64, len(flat))
    lens = np.fromiter(map(len, flat), np.int64, len(flat))
    return h, lens, np.concatenate([[0], np.cumsum(counts)])


def mix(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64 steps) of ``h`` offset by ``k``."""
    with np.errstate(over="ignore"):
        z = h + np.uint64((k * 0x9E3779B97F4A7C15) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers (once per application),
    so that the functions below need no installation on the executors."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="shoplens-zip-")) / f"shoplens_{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with the package shipped to the workers first."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def distributed_rank(df: DataFrame, group: str, order: list[str], run_rows: int,
                     out: str) -> DataFrame:
    """``df`` with ``out``: the gapless rank from 0 of each row within ``group``.

    ``group`` must have a bounded number of values (the caller proves it): its
    sizes are broadcast. A group is dealt into runs of about ``run_rows`` rows
    by a hash of ``order``; the rank is the sum of the earlier runs' sizes plus
    the row number inside the run, so no task holds a whole group. Rows equal
    in ``order`` are ranked among themselves in any order. ``df`` is read three
    times and must give the same rows each time.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__group_rows"))
    dealt = (df.join(F.broadcast(sizes), group)
             .withColumn("__run", F.pmod(F.xxhash64(*order),
                                         F.ceil(F.col("__group_rows") / run_rows)))
             .drop("__group_rows"))
    runs = dealt.groupBy(group, "__run").agg(F.count(F.lit(1)).alias("__rows"))
    before = (Window.partitionBy(group).orderBy("__run")
              .rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(group, "__run",
                       F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(group, "__run").orderBy(*order)
    return (dealt.join(runs, [group, "__run"])
            .withColumn(out, F.col("__before") + F.row_number().over(inside) - 1)
            .drop("__run", "__before"))
