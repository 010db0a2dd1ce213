"""The corpus pipeline: quality rules, toxicity, near copies, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and reread as the next
stage's ``docs``. All but the last return the columns of ``documents``; the
last returns where every piece of the kept documents is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import golay, packing, quality, toxicity
from shoplens.llm.common import read, staged

STAGES = [
    ("quality_rules", quality.stage),
    ("toxicity", toxicity.stage),
    ("simhash_near_dedup", golay.stage),
    ("best_fit_packing", packing.stage),
]

# a fitted model, 64-bit hashes and tokenizer ids are beyond SQL; tests/llm has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; an empty table gives an empty result."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
