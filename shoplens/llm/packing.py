"""Best-fit packing by minimum bin slack: the fullest feasible combination of lengths, bin after bin.

Packing depends on the lengths alone, so the driver sees a histogram of at most
``capacity`` lengths and never a piece. For each bin the largest remaining
length is set and a bitset subset-sum over the remaining lengths finds the
fullest combination with it; the combination is then taken as often as the
histogram allows. The plan that results says, for every length, which ranks go
to which bins; pieces find their place by their rank among pieces of the same
length (a distributed rank) and a join with the plan.

The plan is bounded: a combination is abandoned only when fewer pieces of one
of its lengths remain than it takes, which happens at most capacity/length
times per length, so it has at most about capacity * ln(capacity) combinations.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import distributed_rank, map_arrow, read, schema_with, staged, text_batches

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
RUN_ROWS = 1_000
LONG_SPACE = 250_000  # characters of white space from which a run is encoded apart
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}")


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for
    itself, every other byte for the next character from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE file of the tokenizers library as merge ranks. Their
    ids are the ranks (checked), so both libraries give the same ids; special
    strings inside a text become their special ids, as that library's default."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    alphabet, vocab = byte_alphabet(), spec["model"]["vocab"]
    for i, (a, b) in enumerate(spec["model"]["merges"]):
        if vocab[a + b] != 256 + i:
            raise ValueError(f"{path}: merge {i} is not in the order of its ids")
    ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if token not in special}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=special)


def token_ids(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of ``text``. The engine's regex keeps a step per character of a
    white-space run and gives up at 1,000,000, so a long run is encoded apart,
    as the one token candidate the pattern makes of it: all of it before a
    special string or the end, else all but its last character."""
    if len(text) < LONG_SPACE:
        return enc.encode_to_numpy(text, allowed_special="all")
    special = tuple(enc.special_tokens_set)
    parts, start = [], 0
    for run in _SPACES.finditer(text):
        if run.end() - run.start() < LONG_SPACE:
            continue
        end = run.end() - (run.end() < len(text) and not text.startswith(special, run.end()))
        parts += [enc.encode_to_numpy(text[start:run.start()], allowed_special="all"),
                  enc._encode_single_piece(text[run.start():end])]
        start = end
    parts.append(enc.encode_to_numpy(text[start:], allowed_special="all"))
    return np.concatenate(parts)


def token_pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids_crc32): each text's ids with ``end_id``
    after them, cut into pieces of ``capacity`` ids if longer; a shorter rest is
    the first piece. A null text reads as empty: one piece with the end id."""
    narrow = df.select(F.col(key).alias(key), F.col(text).alias("__text"))
    schema = schema_with(narrow.drop("__text"), piece="integer", start="long", length="long",
                         ids_crc32="long")

    def run(batches):
        enc = encoder(path)
        for b, texts in text_batches(batches, 1):
            row, piece, start, length, crc = [], [], [], [], []
            for r, t in enumerate(texts):
                ids = token_ids(enc, t.decode())
                ids = np.append(ids, end_id).astype("<u4")
                n = len(ids)
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                if n <= capacity:
                    cuts = [0, n]
                for p, (i, j) in enumerate(zip(cuts, cuts[1:])):
                    row.append(r)
                    piece.append(p)
                    start.append(i)
                    length.append(j - i)
                    crc.append(zlib.crc32(ids[i:j].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *(pa.array(c, pa.int64()) for c in (start, length, crc))],
                names=[key, "piece", "start", "length", "ids_crc32"])

    return map_arrow(narrow, run, schema)


def fullest(available: dict[int, int], room: int) -> dict[int, int]:
    """Length -> times of a feasible combination with the largest sum up to ``room``.

    Bit s of a bitset says that sum s can be reached; each length enters with
    its copies in doubling chunks. Longer lengths enter first and the search
    ends when ``room`` itself is reached, so few long pieces are preferred.
    """
    reach, steps = [1], []
    full = (1 << (room + 1)) - 1
    for length in sorted((x for x in available if x <= room), reverse=True):
        copies = min(available[length], room // length)
        chunk = 1
        while copies:
            take = min(chunk, copies)
            reach.append((reach[-1] | reach[-1] << (take * length)) & full)
            steps.append((length, take))
            copies -= take
            chunk *= 2
        if reach[-1] >> room & 1:
            break
    at = reach[-1].bit_length() - 1
    taken: dict[int, int] = {}
    for k in range(len(steps), 0, -1):
        if not reach[k - 1] >> at & 1:
            length, take = steps[k - 1]
            taken[length] = taken.get(length, 0) + take
            at -= length * take
    return taken


def bin_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first bin, pieces per bin, offset) rows that
    place every piece of the histogram."""
    left = {x: n for x, n in histogram.items() if n > 0}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError("lengths must lie in 1..capacity")
    used = dict.fromkeys(left, 0)
    rows, bins = [], 0
    while left:
        largest = max(left)
        rest = dict(left)
        rest[largest] -= 1
        combo = fullest({x: n for x, n in rest.items() if n}, capacity - largest)
        combo[largest] = combo.get(largest, 0) + 1
        times = min(left[x] // m for x, m in combo.items())
        offset = 0
        for x in sorted(combo, reverse=True):
            m = combo[x]
            rows.append((x, used[x], used[x] + m * times, bins, m, offset))
            offset += x * m
            used[x] += m * times
            left[x] -= m * times
            if not left[x]:
                del left[x]
        bins += times
    return rows


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table with a ``length`` column in 1..capacity) with
    ``sequence_id`` and ``offset``. Pieces equal in ``order`` and length are
    interchangeable. An empty table gives an empty one."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(bin_plan(histogram, capacity),
                                 "length long, __from long, __to long, __bin long, __each long, __at long")
    ranked = distributed_rank(pieces, "length", order, RUN_ROWS, "__rank")
    nth = F.col("__rank") - F.col("__from")
    return (ranked.join(F.broadcast(plan), "length")
            .where((F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
            .withColumn("sequence_id", F.col("__bin") + F.floor(nth / F.col("__each")))
            .withColumn("offset", F.col("__at") + nth % F.col("__each") * F.col("length"))
            .select(*pieces.columns, "sequence_id", "offset"))


def packed_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents tokenized, cut and packed with the production parameters."""
    pieces = staged(spark, token_pieces(docs, public_tokenizers.path(TOKENIZER)), "pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: where every piece of the kept documents goes."""
    return packed_documents(spark, docs)


def op2_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packed_documents(spark, read(spark, sf_dir, "documents"))
