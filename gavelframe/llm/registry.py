"""Queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, divergence, html_text, licenses, near_dedup, packing, quality, repeats, secrets, spelling, topk, training_order, vector_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": quality.op1_quality,
    "op2_training_order": training_order.op2_training_order,
    "op3_vector_dedup": vector_dedup.op3_vector_dedup,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_licenses": licenses.op5_licenses,
    "op6_bpe": bpe.op6_bpe,
    "op7_repeats": repeats.op7_repeats,
    "op8_topk": topk.op8_topk,
    "op9_packing": packing.op9_packing,
    "op10_html": html_text.op10_html,
    "op11_divergence": divergence.op11_divergence,
    "op12_secrets": secrets.op12_secrets,
    "op13_spelling": spelling.op13_spelling,
}
ORACLE_SQL: dict[str, str] = {
    "op5_licenses": licenses.ORACLE,
    "op8_topk": topk.ORACLE,
    "op11_divergence": divergence.ORACLE,
    "op12_secrets": secrets.ORACLE,
    "op13_spelling": spelling.ORACLE,
}
