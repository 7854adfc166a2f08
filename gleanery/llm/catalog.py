"""Registered queries of the corpus operators and, where SQL expresses them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanery.llm import (
    bpe,
    chat,
    counting,
    imatch,
    infill,
    mixing,
    packing,
    resampling,
    secrets,
    simhash,
    topk,
    toxicity,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": mixing.op1_mixing,
    "op2_fingerprints": imatch.op2_fingerprints,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_simhash": simhash.op4_simhash,
    "op5_packing": packing.op5_packing,
    "op6_resampling": resampling.op6_resampling,
    "op7_bpe": bpe.op7_bpe,
    "op8_top_k": topk.op8_top_k,
    "op9_secrets": secrets.op9_secrets,
    "op10_edit_counts": counting.op10_edit_counts,
    "op11_whitening": whitening.op11_whitening,
    "op12_infill": infill.op12_infill,
    "op13_chat": chat.op13_chat,
}

ORACLES: dict[str, str] = {
    "op8_top_k": topk.TOP_K_SQL,
    "op12_infill": infill.INFILL_SQL,
    "op13_chat": chat.CHAT_SQL,
}
