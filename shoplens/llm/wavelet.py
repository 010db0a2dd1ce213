"""Token ids in shard files, each a wavelet matrix: succinct bit-planes with rank and select.

``Shard`` reads one file. From the highest bit on, a plane holds that bit of
every id in the plane's order, zeros before ones in the next plane; with a rank
directory per plane this answers, without decoding the shard, which id is at a
place (``access``), how often an id occurs before a place (``rank``) and where
its k-th occurrence is (``select``). A plane is stored in blocks of
``BLOCK_BITS`` bits, each compressed by itself, with the ones before it and its
place in the file; a lookup reads and unpacks the blocks it touches, no others.

File, little-endian: the 8 bytes of ``MAGIC``; the length of the header (u32);
the header (JSON: tokens, planes, block bits, and offset, length, type of each
section); the sections ``zeros`` (per plane), ``ones`` and ``place`` (per plane
and block, one more at the end); then per document piece ``row``, ``doc_id``,
``known`` (0: null id), ``first`` (its place in the document), ``count`` and
``whole`` (1: the piece is the document); then the blocks. Sections and blocks
are Zstandard frames.

Archive: documents are encoded once into a stored table of ids, cut into pieces
of at most ``PIECE`` ids, sorted by range over (doc_id, text hash, row), and each
range task writes shard files of about ``SHARD`` ids in that order. Every try of
a task writes files of new names, and the manifest, a table written by Spark,
names those of the tries that counted, so a lost executor leaves at most unread
files. Where a shard starts among all ids is a running sum over the manifest.

Nulls and ties: a null text is empty (its end id alone); a null doc_id comes
first; rows of one doc_id are ordered by a hash of their text, equal rows in any
order, each a document of its own. Very long texts: a document's ids lie in
several pieces and may lie in several shards; its checksum is combined from
theirs. Empty table: no files, no rows.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import map_arrow, read, staged, text_batches
from shoplens.llm.packing import encoder, token_ids
from shoplens.session import shared_dir

MAGIC = b"SLWMTOK1"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BLOCK_BITS = 1 << 16
PIECE = 1 << 19
SHARD = 1 << 21
CACHED_BLOCKS = 4096
MAX_TASKS = 20_000
PIECE_FIELDS = [("row", "<i8"), ("doc_id", "<i8"), ("known", "u1"), ("first", "<i8"), ("count", "<i8"), ("whole", "u1")]


# --- the shard file ----------------------------------------------------------------

def planes_of(ids: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, int]]:
    """(packed plane, zeros in it) from the highest bit down."""
    a = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    for level in range(bits - 1, -1, -1):
        one = (a >> level & 1).astype(bool)
        low = a[~one]
        yield np.packbits(one, bitorder="little"), len(low)
        a = np.concatenate([low, a[one]])


def shard_bytes(ids: np.ndarray, pieces: dict[str, np.ndarray], bits: int) -> bytes:
    """The file of ``ids`` with its table of pieces."""
    pack = zstandard.ZstdCompressor(level=3).compress
    n, step = len(ids), BLOCK_BITS // 8
    blocks = -(-n // BLOCK_BITS)
    zeros, ones, place, body = [], [], [], []
    at = 0
    for plane, low in planes_of(ids, bits):
        zeros.append(low)
        before = 0
        for k in range(blocks):
            block = plane[k * step:(k + 1) * step]
            ones.append(before)
            place.append(at)
            before += int(np.bitwise_count(block).sum())
            body.append(pack(block.tobytes()))
            at += len(body[-1])
        ones.append(before)
        place.append(at)
    tables = {"zeros": np.array(zeros, "<i8"), "ones": np.array(ones, "<i8"), "place": np.array(place, "<i8"),
              **{name: pieces[name].astype(kind) for name, kind in PIECE_FIELDS}}
    head, packed, at = {"tokens": n, "bits": bits, "block_bits": BLOCK_BITS, "sections": {}}, [], 0
    for name, table in tables.items():
        packed.append(pack(table.tobytes()))
        head["sections"][name] = [at, len(packed[-1]), table.dtype.str]
        at += len(packed[-1])
    head["body"] = at
    text = json.dumps(head).encode()
    return b"".join([MAGIC, struct.pack("<I", len(text)), text, *packed, *body])


class Shard:
    """A shard file through ``fetch(offset, length)``; positions are numpy arrays or integers."""

    def __init__(self, fetch: Callable[[int, int], bytes]):
        start = fetch(0, len(MAGIC) + 4)
        if start[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        size = struct.unpack("<I", start[len(MAGIC):])[0]
        self._fetch, self._sections_at = fetch, len(MAGIC) + 4 + size
        self.head = json.loads(fetch(len(MAGIC) + 4, size))
        self.tokens, self.bits, self.block = (self.head[k] for k in ("tokens", "bits", "block_bits"))
        self._unpack = zstandard.ZstdDecompressor().decompress
        shape = (self.bits, -1)
        self._zeros = self.section("zeros").tolist()
        self._ones, self._place = self.section("ones").reshape(shape), self.section("place").reshape(shape)
        self._cache: OrderedDict[tuple[int, int], tuple] = OrderedDict()

    @classmethod
    def open(cls, path: str) -> "Shard":
        system, name = file_system(path)
        f = system.open_input_file(name)

        def fetch(offset: int, length: int) -> bytes:
            return f.read_at(length, offset)

        return cls(fetch)

    def section(self, name: str) -> np.ndarray:
        at, length, kind = self.head["sections"][name]
        return np.frombuffer(self._unpack(self._fetch(self._sections_at + at, length)), dtype=kind)

    def _bytes(self, plane: int, first: int, last: int) -> bytes:
        """The unpacked blocks first..last-1 of a plane, read at once."""
        a, b = int(self._place[plane, first]), int(self._place[plane, last])
        raw = self._fetch(self._sections_at + self.head["body"] + a, b - a)
        cuts = (self._place[plane, first:last + 1] - a).tolist()
        return b"".join(self._unpack(raw[i:j]) for i, j in zip(cuts, cuts[1:]))

    def _load(self, plane: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """(words, ones before each word) of one block; the last used blocks are kept."""
        key = (plane, block)
        if key not in self._cache:
            raw = self._bytes(plane, block, block + 1)
            words = np.frombuffer(raw + b"\0" * (-len(raw) % 8), dtype="<u8")
            self._cache[key] = words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            if len(self._cache) > CACHED_BLOCKS:
                self._cache.popitem(last=False)
        self._cache.move_to_end(key)
        return self._cache[key]

    def _rank1(self, plane: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each position."""
        block, inside = np.divmod(at, self.block)
        out = self._ones[plane, block].copy()
        for k in np.unique(block[inside > 0]).tolist():
            here = np.flatnonzero((block == k) & (inside > 0))
            words, before = self._load(plane, k)
            word, bit = np.divmod(inside[here], 64)
            last = np.append(words, np.uint64(0))[word] & ((np.uint64(1) << bit.astype(np.uint64)) - np.uint64(1))
            out[here] += before[word] + np.bitwise_count(last)
        return out

    def _bit(self, plane: int, at: np.ndarray) -> np.ndarray:
        block, inside = np.divmod(at, self.block)
        out = np.empty(len(at), dtype=bool)
        for k in np.unique(block).tolist():
            here = np.flatnonzero(block == k)
            word, bit = np.divmod(inside[here], 64)
            out[here] = self._load(plane, k)[0][word] >> bit.astype(np.uint64) & np.uint64(1)
        return out

    def _select(self, plane: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """The position of the nth (from 0) one or zero of a plane."""
        ones = self._ones[plane]
        first = np.minimum(np.arange(len(ones)) * self.block, self.tokens)
        block = np.searchsorted(ones if bit else first - ones, nth, side="right") - 1
        out = np.empty(len(nth), dtype=np.int64)
        for k in np.unique(block).tolist():
            here = np.flatnonzero(block == k)
            words, before = self._load(plane, k)
            size = min(self.block, self.tokens - k * self.block)
            bits = np.unpackbits(words.view(np.uint8), bitorder="little")[:size]
            out[here] = k * self.block + np.flatnonzero(bits == bit)[
                nth[here] - (ones[k] if bit else first[k] - ones[k])]
        return out

    def access(self, positions) -> np.ndarray:
        """The ids at the positions."""
        at = np.atleast_1d(np.asarray(positions, dtype=np.int64))
        if len(at) and (at.min() < 0 or at.max() >= self.tokens):
            raise IndexError("position outside the shard")
        ids = np.zeros(len(at), dtype=np.int64)
        for plane in range(self.bits):
            one, ones = self._bit(plane, at), self._rank1(plane, at)
            ids = ids << 1 | one
            at = np.where(one, self._zeros[plane] + ones, at - ones)
        return ids

    def _walk(self, token: int, at: np.ndarray) -> np.ndarray:
        """Where positions of the first plane's order lie after the last plane,
        counting only rows that agree with ``token``."""
        for plane in range(self.bits):
            ones = self._rank1(plane, at)
            at = self._zeros[plane] + ones if token >> (self.bits - 1 - plane) & 1 else at - ones
        return at

    def rank(self, token: int, positions) -> np.ndarray:
        """How often ``token`` occurs before each position."""
        at = np.atleast_1d(np.asarray(positions, dtype=np.int64))
        if token >> self.bits:
            return np.zeros(len(at), dtype=np.int64)
        both = self._walk(token, np.concatenate([[0], at]))
        return both[1:] - both[0]

    def select(self, token: int, nth) -> np.ndarray:
        """The position of the nth occurrence (from 0) of ``token``; -1 where it has fewer."""
        nth = np.atleast_1d(np.asarray(nth, dtype=np.int64))
        out = np.full(len(nth), -1, dtype=np.int64)
        if token >> self.bits:
            return out
        first, end = self._walk(token, np.array([0, self.tokens]))
        ok = np.flatnonzero((nth >= 0) & (nth < end - first))
        at = first + nth[ok]
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            at = self._select(plane, bit, at - self._zeros[plane] if bit else at)
        out[ok] = at
        return out

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of ``token``."""
        return self.select(token, np.arange(int(self.rank(token, self.tokens)[0])))

    def all(self) -> np.ndarray:
        """All ids in order, plane by plane from the lowest: each plane puts the
        zeros and ones back where they came from."""
        n = self.tokens
        ids = np.zeros(n, dtype=np.uint32)
        for plane in range(self.bits - 1, -1, -1):
            raw = np.frombuffer(self._bytes(plane, 0, self._ones.shape[1] - 1), np.uint8)
            one = np.unpackbits(raw, count=n, bitorder="little").astype(bool)
            back, zeros = np.empty(n, dtype=np.uint32), self._zeros[plane]
            back[~one] = ids[:zeros]
            back[one] = ids[zeros:] | np.uint32(1 << (self.bits - 1 - plane))
            ids = back
        return ids


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    path = re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path)


# --- checksums of parts -----------------------------------------------------------

CRC_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, bits reflected


def _times(a: int, b: int) -> int:
    """Product of two reflected polynomials modulo the CRC's."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        b = b >> 1 ^ (CRC_POLYNOMIAL if b & 1 else 0)
        bit >>= 1
    return out


def crc32_joined(a: int, b: int, length: int) -> int:
    """crc32 of two byte strings end to end, from theirs and the second's length:
    the first is shifted by 8 * length bits, a power of x found by squaring."""
    shift, square, n = 1 << 31, 1 << 30, 8 * length
    while n:
        if n & 1:
            shift = _times(shift, square)
        square = _times(square, square)
        n >>= 1
    return _times(shift, a) ^ b


# --- the archive ------------------------------------------------------------------

def id_width(path: str) -> int:
    """Bits of the tokenizer's largest id."""
    return max(1, (encoder(path).max_token_value).bit_length())


def encoded(spark: SparkSession, docs: DataFrame, path: str, end_id: int, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """A stored table (row, doc_id, tie, piece, whole, ids): every text's ids and
    ``end_id``, in pieces of at most ``PIECE``; ``row`` is a number of its own per document."""
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"),
                         F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"), F.col(text).alias("text"))
    kind = "<u2" if id_width(path) <= 16 else "<u4"

    def run(batches):
        enc = encoder(path)
        for b, texts in text_batches(batches, 3):
            row, piece, whole, ids = [], [], [], []
            for r, t in enumerate(texts):
                x = np.append(token_ids(enc, t.decode()), end_id).astype(kind)
                for p, i in enumerate(range(0, len(x), PIECE)):
                    row.append(r)
                    piece.append(p)
                    whole.append(len(x) <= PIECE)
                    ids.append(x[i:i + PIECE].tobytes())
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).take(take) for k in range(3)), pa.array(piece, pa.int32()), pa.array(whole, pa.bool_()),
                 pa.array(ids, pa.binary())], names=["row", "doc_id", "tie", "piece", "whole", "ids"])

    return staged(spark, map_arrow(narrow, run, "row long, doc_id long, tie long, piece int, whole boolean, ids binary"),
                  "ids")


def write_archive(spark: SparkSession, docs: DataFrame, folder: str, path: str, end_id: int = END_ID,
                  shard: int = SHARD) -> DataFrame:
    """Shard files of all documents under ``folder``, which all executors reach.
    Returns the manifest (file, base, tokens): ``base`` ids come before the file's."""
    order = ["doc_id", "tie", "row", "piece"]
    ids = encoded(spark, docs, path, end_id).repartitionByRange(*order).sortWithinPartitions(*order)
    bits = id_width(path)
    kind = "<u2" if bits <= 16 else "<u4"

    def run(batches):
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            table = {name: np.array([h[i] for h in held]) for i, (name, _) in enumerate(PIECE_FIELDS)}
            data = shard_bytes(np.concatenate([h[-1] for h in held]), table, bits)
            name = f"shard-{part:06d}-{seq:06d}-{uuid.uuid4().hex[:12]}.wm"
            with system.open_output_stream(f"{root}/{name}") as f:
                f.write(data)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                                               "file": [name], "tokens": pa.array([size], pa.int64())})

        for b in batches:
            for row, doc, piece, whole, raw in zip(*(b.column(k).to_pylist() for k in (0, 1, 3, 4, 5))):
                x = np.frombuffer(raw, kind)
                held.append((row, doc or 0, doc is not None, piece * PIECE, len(x), whole, x))
                size += len(x)
                if size >= shard:
                    yield flush()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield flush()

    written = staged(spark, map_arrow(ids, run, "part int, seq int, file string, tokens long"), "manifest")
    # as many rows as range tasks in the first window, as files of one task in the second
    sums = written.groupBy("part").agg(F.sum("tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    based = (written.join(sums, "part")
             .select("file", (F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("base"), "tokens"))
    return staged(spark, based, "manifest")


def over_shards(manifest: DataFrame, folder: str, fn: Callable, schema: str) -> DataFrame:
    """``fn(shard, base)`` (an iterator of record batches) on every file of the manifest, a task at a time."""
    n = manifest.count()

    def run(batches):
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield from fn(Shard.open(f"{folder}/{name}"), base)

    return map_arrow(manifest.select("file", "base").repartition(min(max(n, 1), MAX_TASKS), "file"), run, schema)


def token_counts(manifest: DataFrame, folder: str, tokens: list[int]) -> DataFrame:
    """(token, n) over the whole archive, by rank: no shard is decoded."""
    def run(shard, base):
        n = [int(shard.rank(t, shard.tokens)[0]) for t in tokens]
        yield pa.RecordBatch.from_pydict({"token": pa.array(tokens, pa.int64()), "n": pa.array(n, pa.int64())})

    return over_shards(manifest, folder, run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(manifest: DataFrame, folder: str, token: int) -> DataFrame:
    """(doc_id, at, place): every place of a token in its document and among all ids, by select."""
    def run(shard, base):
        at = shard.occurrences(token)
        count = shard.section("count")
        starts = np.cumsum(count) - count
        piece = np.searchsorted(starts, at, side="right") - 1
        doc = pa.array(shard.section("doc_id")[piece], mask=shard.section("known")[piece] == 0)
        yield pa.RecordBatch.from_arrays([doc, pa.array(shard.section("first")[piece] + at - starts[piece]),
                                          pa.array(base + at)], names=["doc_id", "at", "place"])

    return over_shards(manifest, folder, run, "doc_id long, at long, place long")


PART_SCHEMA = ("row long, doc_id long, whole boolean, first long, start long, n long, crc long, "
               "ends long, end_at long, last_id long")
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, n_end_ids long, end_at long, last_id long"


def read_archive(spark: SparkSession, manifest: DataFrame, folder: str, end_id: int = END_ID) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of the
    decoded ids), n_end_ids (end ids in it, by rank), end_at (place of the first
    one in it, by select) and last_id (by access)."""
    def run(shard, base):
        count, first = shard.section("count"), shard.section("first")
        stops = np.cumsum(count)
        starts = stops - count
        raw = shard.all().astype("<u4")
        crc = [zlib.crc32(raw[i:j]) for i, j in zip(starts.tolist(), stops.tolist())]
        before = shard.rank(end_id, starts)
        ends = shard.rank(end_id, stops) - before
        at = np.where(ends > 0, first + shard.select(end_id, before) - starts, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard.section("row")), pa.array(shard.section("doc_id"), mask=shard.section("known") == 0),
             pa.array(shard.section("whole") == 1), pa.array(first), pa.array(base + starts), pa.array(count),
             pa.array(crc, pa.int64()), pa.array(ends), pa.array(at), pa.array(shard.access(stops - 1))],
            names=[c.split()[0] for c in PART_SCHEMA.split(", ")])

    def join(batches):
        for b in batches:
            out = []
            for doc, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                crc = 0
                for p in parts:
                    crc = crc32_joined(crc, p["crc"], 4 * p["n"])
                at = [p["end_at"] for p in parts if p["end_at"] >= 0]
                out.append((doc, parts[0]["start"], sum(p["n"] for p in parts), crc,
                            sum(p["ends"] for p in parts), min(at, default=-1), parts[-1]["last_id"]))
            names = [c.split()[0] for c in DOC_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(len(names))],
                                             names=names)

    parts = staged(spark, over_shards(manifest, folder, run, PART_SCHEMA), "parts")
    # one row per PIECE ids of a very long text
    long = (parts.where(~F.col("whole")).groupBy("row")
            .agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct(
                "first", "start", "n", "crc", "ends", "end_at", "last_id"))).alias("parts")))
    short = parts.where("whole").select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"),
                                        F.col("ends").alias("n_end_ids"), "end_at", "last_id")
    return short.union(map_arrow(long.select("doc_id", "parts"), join, DOC_SCHEMA))


def op11_wavelet_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as wavelet-matrix shards and read back."""
    folder = os.path.join(shared_dir(spark), "llm", f"tokens-{uuid.uuid4().hex}")
    manifest = write_archive(spark, read(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER))
    return read_archive(spark, manifest, folder)
