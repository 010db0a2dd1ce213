"""Token counts by compiled finite-state transducers.

Two deterministic transducers stand in for the tokenizer. The first runs over
character classes and marks where each word of the split pattern begins. It has
five states, so a chunk of text is a map from start state to end state; the
maps of all chunks of a slice are stepped side by side, composed by a parallel
prefix scan, and then every chunk knows its start state.

The second runs over the bytes of a word and is compiled as bytes are met. A
state holds what later merges can still see of the word so far: for each suffix
that some token begins with, its trie node, the last token before it, and how
many tokens lie before it, relative to now. The last token of a prefix is the one
token that ends there and stands next to the last token before it without
merging; so each transition emits a (signed) change of the token count, and a
word's count is the sum along its path. The states are given by the vocabulary,
not by the corpus; the tables start afresh when they outgrow ``MAX_TRANSITIONS``.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import map_arrow, read, schema_with, text_batches
from shoplens.llm.rankbpe import LETTER, NUMBER, OTHER, SPACE, WordBPE, known_points, newer_kind, normalised

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 64
MAX_TRANSITIONS = 1_000_000
MAX_WORDS = 200_000

APOSTROPHE_2, APOSTROPHE_3, UNKNOWN = 4, 5, 6
BETWEEN, IN_LETTERS, IN_OTHER, ONE_MORE, TWO_MORE = range(5)
# white space of the split pattern (fixed values: the Unicode property White_Space)
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# contractions that the pattern cuts off (fixed values)
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def split_tables() -> tuple[np.ndarray, np.ndarray]:
    """(next state, word begins) by class and state."""
    step = np.zeros((6, 5), dtype=np.uint8)
    begins = np.zeros((6, 5), dtype=bool)
    fresh = {SPACE: BETWEEN, LETTER: IN_LETTERS, NUMBER: BETWEEN, OTHER: IN_OTHER,
             APOSTROPHE_2: ONE_MORE, APOSTROPHE_3: TWO_MORE}
    for kind, state in fresh.items():
        for now in (BETWEEN, IN_LETTERS, IN_OTHER):
            step[kind, now] = state
            begins[kind, now] = kind != SPACE
        step[kind, ONE_MORE], step[kind, TWO_MORE] = BETWEEN, ONE_MORE
    begins[LETTER, IN_LETTERS] = False
    for kind in (OTHER, APOSTROPHE_2, APOSTROPHE_3):  # a run of other characters takes apostrophes in
        step[kind, IN_OTHER], begins[kind, IN_OTHER] = IN_OTHER, False
    return step, begins


STEP, BEGINS = split_tables()


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point; those that Python's tables have not are filled in as they are met."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for c in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(c))[0])
        if kind is not None:
            table[c] = kind
    table[~known_points()] = UNKNOWN
    table[WHITE] = SPACE
    return table


def classify(points: np.ndarray) -> np.ndarray:
    """Classes of the characters; an apostrophe that opens a contraction has a class of its own."""
    table = char_classes()
    kinds = table[points]
    newer = points[kinds == UNKNOWN]
    if len(newer):
        for c in np.unique(newer).tolist():
            table[c] = newer_kind(c)
        kinds = table[points]
    at = np.flatnonzero(points == ord("'"))
    if len(at):
        padded = np.append(points, [0, 0])
        for short in CONTRACTIONS:
            fits = np.all([padded[at + i] == ord(short[i]) for i in range(1, len(short))], axis=0)
            kinds[at[fits]] = APOSTROPHE_2 if len(short) == 2 else APOSTROPHE_3
    return kinds


def word_begins(kinds: np.ndarray) -> np.ndarray:
    """Which characters begin a word: chunk state maps, their prefix scan, then one pass from known states."""
    n = len(kinds)
    chunks = -(-n // CHUNK)
    padded = np.zeros(chunks * CHUNK, dtype=np.uint8)
    padded[:n] = kinds
    steps = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    maps = np.tile(np.arange(5, dtype=np.uint8), (chunks, 1))
    for kind in steps:
        maps = STEP[kind[:, None], maps]
    reach = 1
    while reach < chunks:  # after each turn, map i covers twice as many chunks up to i
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        reach *= 2
    state = np.concatenate([[BETWEEN], maps[:-1, BETWEEN]]).astype(np.uint8)
    out = np.empty((CHUNK, chunks), dtype=bool)
    for i, kind in enumerate(steps):
        out[i] = BEGINS[kind, state]
        state = STEP[kind, state]
    return out.T.reshape(-1)[:n]


class CountTransducer(dict):
    """(state << 9 | symbol) -> next state << 8 | 128 + emitted; compiled on demand.

    A symbol is a byte, plus 256 for a word's last byte."""

    def __init__(self, bpe: WordBPE):
        super().__init__()
        self.bpe = bpe
        parts_of = {}
        for b in range(256):
            parts_of[bpe.inner[b]], parts_of[bpe.final[b]] = (b,), (b + 256,)
        for pair, i in bpe.rank.items():
            parts_of[bpe.merged[i]] = parts_of[pair >> 16] + parts_of[pair & 0xFFFF]
        self.symbols = parts_of
        self.base = [*bpe.inner, *bpe.final]
        self.trie: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        nodes = 1
        for token, parts in parts_of.items():
            if bpe.merge_parts([self.base[s] for s in parts]) != [token]:
                continue  # other merges come first, so it never stands in a result
            node = 0
            for s in parts:
                child = self.trie.get(node << 9 | s)
                if child is None:
                    child = self.trie[node << 9 | s] = nodes
                    nodes += 1
                node = child
            self.token_at[node] = token
        self.together: dict[int, bool] = {}
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.states: list[tuple] = [((0, -1, 0),)]
        self.number = {self.states[0]: 0}

    def stand(self, left: int, right: int) -> bool:
        """Two tokens side by side stay as they are."""
        key = left << 16 | right
        if key not in self.together:
            parts = [self.base[s] for s in self.symbols[left] + self.symbols[right]]
            self.together[key] = self.bpe.merge_parts(parts) == [left, right]
        return self.together[key]

    def __missing__(self, key: int) -> int:
        symbol = key & 511
        last = emitted = None
        kept = []
        for node, before, count in self.states[key >> 9]:
            child = self.trie.get(node << 9 | symbol)
            if child is None:
                continue
            kept.append((child, before, count))
            token = self.token_at.get(child)
            if last is None and token is not None and (before < 0 or self.stand(before, token)):
                last, emitted = token, count + 1
        state = tuple((node, before, count - emitted) for node, before, count in kept) + ((0, last, 0),)
        if symbol >= 256:
            state = self.states[0]  # the word is over
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
        self[key] = value = self.number[state] << 8 | 128 + emitted
        return value

    def count(self, word: bytes) -> int:
        if len(self) > MAX_TRANSITIONS:
            self.restart()
        if len(self.together) > MAX_TRANSITIONS:
            self.together.clear()
        state = total = 0
        for b in word[:-1]:
            value = self[state << 9 | b]
            state = value >> 8
            total += (value & 255) - 128
        return total + (self[state << 9 | word[-1] | 256] & 255) - 128


class WordCounts(dict):
    """Token count of a word; remembers a bounded number."""

    def __init__(self, path: str):
        super().__init__()
        self.bpe = WordBPE(path)
        self.transducer = CountTransducer(self.bpe)

    def __missing__(self, word: bytes) -> int:
        n = self.transducer.count(word)
        if len(self) < MAX_WORDS:
            self[word] = n
        return n

    def of_texts(self, texts: list[str]) -> np.ndarray:
        """Token counts of whole texts."""
        pieces, owner = [], []
        special = np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            cut = self.bpe.split.split(t) if "<|" in t else [t]
            special[i] = len(cut) // 2  # texts and special strings in turn
            pieces += [normalised(p) + " " for p in cut[::2]]
            owner += [i] * len(cut[::2])
        joined = "".join(pieces)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if not len(points):
            return special
        kinds = classify(points)
        begins = word_begins(kinds)
        edges = np.flatnonzero(begins | (kinds == SPACE))
        first = np.flatnonzero(begins[edges])  # the text ends with a space, so every word has a next edge
        raw = joined.encode()
        if len(raw) == len(points):
            a, b = edges[first], edges[first + 1]
        else:
            size = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int64)
            at = np.cumsum(size) - size
            a, b = at[edges[first]], at[edges[first + 1]]
        counts = np.fromiter(map(self.__getitem__, [raw[i:j] for i, j in zip(a.tolist(), b.tolist())]),
                             np.int64, len(first))
        starts = np.cumsum([0, *map(len, pieces)])
        piece = np.searchsorted(starts, edges[first], side="right") - 1
        return special + np.bincount(np.array(owner)[piece], weights=counts,
                                     minlength=len(texts)).astype(np.int64)


@lru_cache(maxsize=2)
def counter(path: str) -> WordCounts:
    return WordCounts(path)


def with_token_count(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` with the token count of each whole text; null texts read as empty and count 0."""
    where = df.columns.index(text)
    names = [*df.columns, out]

    def run(batches):
        counts = counter(path)
        for b, texts in text_batches(batches, where):
            n = counts.of_texts([t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n)], names=names)

    return map_arrow(df, run, schema_with(df, **{out: "long"}))


def op9_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = with_token_count(docs, public_tokenizers.path(TOKENIZER))
    return counted.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > LIMIT).alias("over_limit"))
