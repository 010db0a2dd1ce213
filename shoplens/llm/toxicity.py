"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the hashes of single words, adjacent pairs and pairs one word
apart (lower case, outer punctuation off), each present or absent. The model is
fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, the smallest
hashes of doc_id): their features are made by all executors, and one task runs
the online learner over them, with a rate per coordinate from its own gradients
(z, n). The bias starts at the sample's log odds; features of fewer than
``MIN_DOCS`` sampled texts are left out, and L1 leaves few of the other weights
off zero, so the model that travels to the scoring tasks is small (at most 2**20
weights, some hundreds in practice). Labels, language, source and doc_id are
never features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import WordHasher, map_arrow, mix, read, schema_with, staged, text_batches

BUCKETS = 1 << 20
SAMPLE_ROWS = 12_000  # the fit is on a sample of at most so many labelled rows
EPOCHS = 4
MIN_DOCS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 8.0, 0.1
NO_LABELS_BIAS = -5.0
FOLD = "crc32(cast(doc_id as string)) % 5"
EDGES = b".,;:!?\"'()[]{}<>|*#$%&-_/\\"
_HASHER = WordHasher(seed=7)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every feature occurrence, for whole texts."""
    words = [[w.strip(EDGES) for w in t.lower().split()] for t in texts]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    flat = [w for ws in words for w in ws]
    h = np.fromiter(map(_HASHER.__getitem__, flat), np.uint64, len(flat))
    doc = np.repeat(np.arange(len(texts)), counts)
    docs, hashes = [doc], [mix(h, 11)]
    for gap in (1, 2):
        same = doc[gap:] == doc[:-gap]
        with np.errstate(over="ignore"):
            pair = mix(h[:-gap], 11 + gap) * np.uint64(3) + mix(h[gap:], 21 + gap)
        docs.append(doc[gap:][same])
        hashes.append(mix(pair[same], 31))
    return np.concatenate(docs), (np.concatenate(hashes) & np.uint64(BUCKETS - 1)).astype(np.int64)


class Learner:
    """FTRL-proximal over present-or-absent features; coordinate BUCKETS is the
    bias, which starts at ``prior`` and is not made sparse."""

    def __init__(self, prior: float):
        self.prior = prior
        self.z, self.n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(self, at) -> np.ndarray:
        z, rate = self.z[at], (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / rate)

    def bias(self) -> float:
        return self.prior - self.z[BUCKETS] / ((BETA + np.sqrt(self.n[BUCKETS])) / ALPHA + L2)

    def learn(self, buckets: np.ndarray, label: int) -> None:
        w = np.append(self.weights(buckets), self.bias())
        at = np.append(buckets, BUCKETS)
        g = sigmoid(w.sum()) - label
        n = self.n[at]
        w[-1] -= self.prior
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class Model:
    """The weights other than zero, by increasing bucket, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        table = np.zeros(BUCKETS, dtype=np.float32)
        table[self.buckets] = self.weights
        doc, bucket = features(texts)
        hit = table[bucket] != 0
        pairs = np.unique(doc[hit] * BUCKETS + bucket[hit])
        total = np.bincount(pairs // BUCKETS, weights=table[pairs % BUCKETS], minlength=len(texts))
        return sigmoid(total + self.bias)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic, order) of at most ``rows`` labelled documents outside the
    held-out fold. A doc_id with several labels counts as its largest, one with
    several texts by its least text, so a repeated doc_id is one document."""
    chosen = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(f"{FOLD} <> 0")
              .groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
              .withColumn("__order", F.xxhash64("doc_id")).orderBy("__order", "doc_id").limit(rows))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "__toxic", "__order").agg(F.min("text").alias("text"))
            .select("text", F.col("__toxic").alias("toxic"), F.col("__order").alias("order")))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """The model of a bounded sample. Without labelled rows every weight is zero
    and the bias says not toxic."""
    sample = labelled_sample(docs, labels, rows)

    def extract(batches):
        for b, texts in text_batches(batches, 0):
            doc, bucket = features(texts)
            pairs = np.unique(doc * BUCKETS + bucket)
            cuts = np.searchsorted(pairs, np.arange(1, len(texts)) * BUCKETS)
            found = [(p % BUCKETS).astype("<u4").tobytes() for p in np.split(pairs, cuts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), b.column(1), b.column(2)],
                names=["features", "toxic", "order"])

    found = staged(spark, map_arrow(
        sample.select("text", F.col("toxic").cast("int").alias("toxic"), "order"), extract,
        "features binary, toxic int, order long"), "features")

    def learn(batches):
        texts, labels = [], []
        for b in batches:
            texts += [np.frombuffer(x, "<u4") for x in b.column(0).to_pylist()]
            labels += b.column(1).to_pylist()
        if not labels:
            return
        in_docs = np.zeros(BUCKETS, dtype=np.int64)
        for x in texts:
            in_docs[x] += 1
        texts = [x[in_docs[x] >= MIN_DOCS].astype(np.int64) for x in texts]
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        learner = Learner(float(np.log(share / (1 - share))))
        for _ in range(EPOCHS):
            for x, y in zip(texts, labels):
                learner.learn(x, y)
        w = learner.weights(slice(0, BUCKETS))
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(kept, BUCKETS)), pa.array(np.append(w[kept], learner.bias()))],
            names=["bucket", "weight"])

    # one task sees at most ``rows`` feature lists; at most 2**20 + 1 weights come back
    one = found.repartition(1).sortWithinPartitions("order").select("features", "toxic")
    model = map_arrow(one, learn, "bucket long, weight double").toPandas()
    if not len(model):
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), NO_LABELS_BIAS)
    bucket = model["bucket"].to_numpy(dtype=np.int64)
    weight = model["weight"].to_numpy(dtype=float)
    return Model(bucket[:-1], weight[:-1].astype(np.float32), float(weight[-1]))


def with_score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the model's score (0 to 1) of each whole text; null texts read as empty."""
    where = df.columns.index(text)
    names = [*df.columns, out]

    def run(batches):
        for b, texts in text_batches(batches, where):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(texts))], names=names)

    return map_arrow(df, run, schema_with(df, **{out: "double"}))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that a model of this stage's own labelled
    documents does not call toxic, columns unchanged."""
    model = fit(spark, docs, read(spark, sf_dir, "labels"))
    return with_score(docs, model, out="__score").where("__score < 0.5").select(*docs.columns)


def op7_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; held_out marks the fold never learnt from."""
    docs = read(spark, sf_dir, "documents")
    model = fit(spark, docs, read(spark, sf_dir, "labels"))
    return with_score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(F.expr(f"{FOLD} = 0"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
