"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    cost_packing,
    exact_dedup,
    gumbel_pieces,
    hard_negatives,
    hmm,
    langid,
    line_dedup,
    near_dedup,
    packing,
    pii,
    quality,
    suffix_dedup,
    turn_repair,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found = [hmm.op1_hidden_markov, exact_dedup.op2_exact_dedup, near_dedup.op3_multi_index_hamming, quality.op4_quality_ratio,
             gumbel_pieces.op5_gumbel_segmentations, packing.op6_best_fit_packing, pii.op7_pii_spans,
             langid.op8_byte_cnn, line_dedup.op9_segment_edit_join, suffix_dedup.op10_suffix_sort,
             hard_negatives.op11_strassen_negatives, cost_packing.op12_cost_balanced_packing, turn_repair.op13_turn_repair]
    return {f.__name__: f for f in found}


def oracle() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.OP2_SQL, "op11_strassen_negatives": hard_negatives.OP11_SQL}
