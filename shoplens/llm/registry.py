"""Registered corpus queries: name -> callable(spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from shoplens.llm import (fingerprints, golay, hilbert, licenses, merkle, negatives, packing, quality,
                          rankbpe, tokencount, toxicity, warc, wavelet)
from shoplens.llm.oracle_sql import OP3_SQL, OP10_SQL, OP12_SQL, OP13_SQL

_FUNCTIONS = (
    fingerprints.op1_simhash_fingerprints,
    packing.op2_minimum_bin_slack,
    quality.op3_rule_ledger,
    hilbert.op4_hilbert_shards,
    golay.op5_golay_near_dedup,
    rankbpe.op6_rank_array_bpe,
    toxicity.op7_ftrl_toxicity,
    licenses.op8_license_scan,
    tokencount.op9_transducer_token_counts,
    warc.op10_content_addressed_warc,
    wavelet.op11_wavelet_token_shards,
    negatives.op12_secondary_sort_negatives,
    merkle.op13_slot_pivot_merkle,
)

QUERIES = {f.__name__: f for f in _FUNCTIONS} | {"pipeline": corpus_pipeline.run}

# the other queries use hashes, tokenizers, curves or fitted models that SQL has not;
# tests/llm holds them against brute force, round trips or held-out labels
ORACLE = {
    "op3_rule_ledger": OP3_SQL,
    "op10_content_addressed_warc": OP10_SQL,
    "op12_secondary_sort_negatives": OP12_SQL,
    "op13_slot_pivot_merkle": OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
