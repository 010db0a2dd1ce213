"""BPE encoding and decoding with a contiguous rank array per word.

A word is held as two short arrays: the ids of its parts, and the merge rank of
every adjacent pair. The smallest rank is found by a scan, its boundary is
deleted, and the two neighbouring ranks are refreshed, until no pair can merge.
Words longer than ``SHORT`` parts take the same merges from a heap, so a very
long word does not cost its length squared. Splitting and normalisation follow
the file: special strings are cut out first, then NFC and lower case, then the
split pattern; each word's last byte carries the end-of-word suffix. Characters
newer than Python's Unicode tables are asked of the tokenizers library, whose
tables are newer (``known_points``). Repeated rows each give their ids.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from shoplens.llm.common import map_arrow, read, schema_with, text_batches
from shoplens.llm.packing import byte_alphabet

TOKENIZER = "word_bpe_49k.json"
SHORT = 96
CACHED_WORDS = 200_000
NEVER = 1 << 30
SPACE, LETTER, NUMBER, OTHER = range(4)  # how the split pattern takes a character
_PATTERN = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_STAND_INS = {SPACE: " ", LETTER: "\u00e9", NUMBER: "1", OTHER: "!"}  # known ones that no contraction holds


@lru_cache(maxsize=1)
def known_points() -> np.ndarray:
    """Whether Python's Unicode tables have each code point. For those, the
    library and Python agree on normalisation and classes; for the others,
    which the library may know, it is asked."""
    return np.array([unicodedata.category(chr(c)) != "Cn" for c in range(0x110000)])


def newer_points(text: str) -> np.ndarray:
    """The code points of a text that Python's tables have not."""
    if text.isascii():
        return np.zeros(0, np.uint32)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return points[~known_points()[points]]


@lru_cache(maxsize=1)
def _library():
    return (normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]),
            pre_tokenizers.Split(Regex(_PATTERN), "removed", invert=True))


@lru_cache(maxsize=1 << 16)
def newer_kind(point: int) -> int:
    """The class that the library's split gives a code point Python's tables have not."""
    split = _library()[1].pre_tokenize_str
    if len(split(f"a{chr(point)}a")) == 1:
        return LETTER
    return {1: OTHER, 2: SPACE, 3: NUMBER}[len(split(f"!{chr(point)}!"))]


class WordBPE(dict):
    """Word (normalised) -> its ids as little-endian 32-bit integers; remembers a bounded number."""

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or spec["model"]["type"] != "BPE":
            raise ValueError(f"{path}: not a file of the expected kind")
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.cached = cached
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_ids = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        letters = {b: c for c, b in byte_alphabet().items()}
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.final = [vocab[letters[b] + suffix] for b in range(256)]
        self.rank, self.merged = {}, []
        for i, (a, b) in enumerate(spec["model"]["merges"]):
            self.rank.setdefault(vocab[a] << 16 | vocab[b], i)
            self.merged.append(vocab[a + b])
        self.token = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = t

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.merge(word.encode()), "<u4").tobytes()
        if len(self) < self.cached:
            self[word] = ids
        return ids

    def merge(self, word: bytes) -> list[int]:
        parts = [self.inner[b] for b in word[:-1]]
        parts.append(self.final[word[-1]])
        return self.merge_parts(parts)

    def merge_parts(self, parts: list[int]) -> list[int]:
        if len(parts) > SHORT:
            return self.merge_long(parts)
        get, merged = self.rank.get, self.merged
        ranks = [get(a << 16 | b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            at = ranks.index(low)
            parts[at] = merged[low]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] << 16 | parts[at], NEVER)
            if at < len(ranks):
                ranks[at] = get(parts[at] << 16 | parts[at + 1], NEVER)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        get, merged, n = self.rank.get, self.merged, len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := get(parts[i] << 16 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue  # one of the two has merged meanwhile
            parts[i], parts[j] = merged[r], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (s := get(parts[x] << 16 | parts[y])) is not None:
                    heapq.heappush(heap, (s, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> bytes:
        pieces = self.split.split(text) if "<|" in text else [text]
        return b"".join([self.special_ids[p] if p in self.special_ids
                         else b"".join(map(self.__getitem__, self.words_of(normalised(p))))
                         for p in pieces])

    def words_of(self, text: str) -> list[str]:
        """The words of a normalised text; a newer character is cut like a known one of its class."""
        newer = set(newer_points(text).tolist())
        if not newer:
            return self.words.findall(text)
        like = text.translate({c: _STAND_INS[newer_kind(c)] for c in newer})
        return [text[m.start():m.end()] for m in self.words.finditer(like)]

    def decode(self, ids: np.ndarray) -> str:
        """The file names no decoder, so tokens are joined with spaces."""
        return " ".join(map(self.token.__getitem__, ids.tolist()))


def normalised(text: str) -> str:
    """NFC, then each character in lower case by itself (a final sigma is no exception)."""
    if len(newer_points(text)):
        return _library()[0].normalize_str(text)
    text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBPE:
    return WordBPE(path)


def with_ids(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids of column ``text`` as little-endian unsigned 32-bit
    integers (binary). A null text reads as empty and has no ids."""
    where = df.columns.index(text)
    names = [*df.columns, out]

    def run(batches):
        bpe = tokenizer(path)
        for b, texts in text_batches(batches, where):
            ids = pa.array([bpe.encode(t.decode()) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=names)

    return map_arrow(df, run, schema_with(df, **{out: "binary"}))


def with_decoded(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids (as ``with_ids`` gives them) decode to."""
    where = df.columns.index(ids)
    names = [*df.columns, out]

    def run(batches):
        bpe = tokenizer(path)
        for b, coded in text_batches(batches, where):
            texts = pa.array([bpe.decode(np.frombuffer(x, "<u4")) for x in coded], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=names)

    return map_arrow(df, run, schema_with(df, **{out: "string"}))


def op6_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; the digests are taken from the ids and the text."""
    path = public_tokenizers.path(TOKENIZER)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = with_ids(docs, path).select("doc_id", "ids")
    return with_decoded(coded, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
