"""Registered corpus queries and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import op01_ngram_join, op02_pitman_yor, op03_pii, op04_imatch, op05_token_ids, op06_toxicity, op07_warc, op08_line_dedup, op09_mix, op10_decontaminate, op11_hard_negatives, op12_whitening, op13_top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op01_ngram_join.op1_ngram_join,
    "op2_pitman_yor": op02_pitman_yor.op2_pitman_yor,
    "op3_pii": op03_pii.op3_pii,
    "op4_imatch": op04_imatch.op4_imatch,
    "op5_token_ids": op05_token_ids.op5_token_ids,
    "op6_toxicity": op06_toxicity.op6_toxicity,
    "op7_warc": op07_warc.op7_warc,
    "op8_line_dedup": op08_line_dedup.op8_line_dedup,
    "op9_mix": op09_mix.op9_mix,
    "op10_decontaminate": op10_decontaminate.op10_decontaminate,
    "op11_hard_negatives": op11_hard_negatives.op11_hard_negatives,
    "op12_whitening": op12_whitening.op12_whitening,
    "op13_top_k": op13_top_k.op13_top_k,
}

SQL: dict[str, str] = {
    "op1_ngram_join": op01_ngram_join.SQL,
    "op4_imatch": op04_imatch.SQL,
    "op7_warc": op07_warc.SQL,
    "op10_decontaminate": op10_decontaminate.SQL,
    "op11_hard_negatives": op11_hard_negatives.SQL,
    "op13_top_k": op13_top_k.SQL,
}
