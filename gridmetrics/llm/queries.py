"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    byte_bpe,
    compact_windows,
    dart_minhash,
    divergence,
    feistel,
    html_blocks,
    lattice,
    prefix_chat,
    quality,
    topk,
    toxicity,
    wavelet_fim,
    wu_manber,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": quality.query,
    "op2_lattice": lattice.query,
    "op3_html_blocks": html_blocks.query,
    "op4_feistel": feistel.query,
    "op5_byte_bpe": byte_bpe.query,
    "op6_dart_minhash": dart_minhash.query,
    "op7_decontamination": wu_manber.query,
    "op8_toxicity": toxicity.query,
    "op9_compact_windows": compact_windows.query,
    "op10_exact_topk": topk.query,
    "op11_source_divergence": divergence.query,
    "op12_wavelet_fim": wavelet_fim.query,
    "op13_prefix_chat": prefix_chat.query,
}

ORACLE: dict[str, str] = {
    "op7_decontamination": wu_manber.ORACLE,
    "op10_exact_topk": topk.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op12_wavelet_fim": wavelet_fim.ORACLE,
    "op13_prefix_chat": prefix_chat.ORACLE,
}
