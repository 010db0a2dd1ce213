"""Quality rules: a ledger of failure bits and measurements, policies over it, ablations by bits.

Every rule is evaluated once per text. The ledger row holds the measurements
and one integer whose bit i is set if rule i failed. A policy is a versioned
set of rules (a mask); applying it or taking a rule out is integer work on the
ledger and never touches the texts again. A null text reads as none: it has no
words and fails ``min_words``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import map_arrow, read, schema_with, staged, text_batches

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_shouts"]
# rule name -> condition on the measurements (m: name -> column) under which a
# text fails it; the position is the rule's bit
RULES = {
    "min_words": lambda m: m("n_words") < 50,
    "repeat_words": lambda m: 100 * m("n_repeat_words") > 50 * m("n_words"),
    "symbols": lambda m: 4 * m("n_symbols") > m("n_words"),
    "dup_lines": lambda m: (m("n_lines") >= 4) & (10 * m("n_dup_lines") > 3 * m("n_lines")),
    "word_length": lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 25 * m("n_words")),
    "shouting": lambda m: 4 * m("n_shouts") > m("n_words"),
}


@dataclass(frozen=True)
class Policy:
    """A named version of the rule set that a text must not fail."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        order = list(RULES)
        return sum(1 << order.index(r) for r in self.rules)


BASE = Policy("base", ("min_words", "repeat_words"))
V1 = Policy("v1", tuple(RULES))


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of MEASURES."""
    words = text.split()
    n = len(words)
    # a UTF-8 code point has exactly one byte that is not a continuation byte
    chars = len(text.decode("utf-8", "replace")) - sum(text.count(bytes([c])) for c in SPACES)
    symbols = sum(text.count(bytes([c])) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n >= 4:
        windows = list(zip(words, words[1:], words[2:]))
        seen = Counter(windows)
        if len(seen) < len(windows):
            covered = bytearray(n)
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    covered[i:i + 3] = b"\1\1\1"
            repeated = sum(covered)
    shout = text.count(b"!!")
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines), shout


def with_ledger(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with the measurements and ``failures``, each name after ``prefix``;
    every rule of RULES is evaluated once per row."""
    names = [prefix + m for m in MEASURES]
    where = df.columns.index(text)
    schema = schema_with(df, **dict.fromkeys(names, "long"))

    def run(batches):
        for b, texts in text_batches(batches, where):
            columns = zip(*map(measure, texts))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(c, pa.int64()) for c in columns)],
                names=[*b.schema.names, *names])

    bits = sum((F.when(failed(lambda m: F.col(prefix + m)), 1 << i).otherwise(0)
                for i, failed in enumerate(RULES.values())), F.lit(0))
    return map_arrow(df, run, schema).withColumn(prefix + "failures", bits.cast("int"))


def passes(policy: Policy, prefix: str = ""):
    """Column: the ledger row fails no rule of the policy."""
    return F.col(prefix + "failures").bitwiseAND(F.lit(policy.mask)) == 0


def ablation(led: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: texts that fail it, texts that fail it alone
    (kept if the rule were dropped), and texts kept by the policy. The ledger
    shrinks to one row per combination of bits before any rule is looked at."""
    combos = (led.select(F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("bits"), "n_words")
              .groupBy("bits").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_words").alias("words")))
    order = list(RULES)
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << order.index(r)).alias("bit"))
                      for r in policy.rules])
    per = combos.select("bits", "docs", "words", F.explode(rules).alias("r")).select("*", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return per.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("docs")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("docs")).otherwise(0)).alias("failed_alone"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("words")).otherwise(0)).alias("words_regained"),
        F.sum(F.when(F.col("bits") == 0, F.col("docs")).otherwise(0)).alias("kept"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that pass policy v1, columns unchanged."""
    return with_ledger(docs, prefix="__").where(passes(V1, "__")).select(*docs.columns)


def alone(policy: Policy):
    """Column: the one rule of the policy that a text fails, null if none or more."""
    order, bits = list(RULES), F.col("failures").bitwiseAND(F.lit(policy.mask))
    return F.coalesce(*[F.when(bits == (1 << order.index(r)), F.lit(r)) for r in policy.rules])


def op3_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of all documents with the verdicts of the base rules and policy v1,
    and for a document that one rule alone rejects, that rule with its ablation:
    the documents and words that policy v1 would regain without it."""
    led = staged(spark, with_ledger(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "ledger")
    # one row per rule of the policy
    without = ablation(led, V1).select(F.col("rule").alias("alone"), F.col("failed_alone").alias("alone_docs"),
                                       F.col("words_regained").alias("alone_words"))
    return led.withColumn("alone", alone(V1)).join(F.broadcast(without), "alone", "left").select(
        "doc_id", *MEASURES[:5], (~passes(BASE)).alias("base_failed"), (passes(BASE) & passes(V1)).alias("kept"),
        "failures", "alone", "alone_docs", "alone_words")
