"""Registry of the training-data queries: each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, decontaminate, hilbert, lexical_search, line_dedup, packing, quality_model, quality_rules, recompression, rollups, simhash, suffix_dedup, warc
from .common import table


def _on_documents(f: Callable[[SparkSession, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(spark, table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_benchmark_decontamination": decontaminate.op1,
        "op2_suffix_array_dedup": _on_documents(suffix_dedup.op2),
        "op3_recompression_dedup": _on_documents(recompression.op3),
        "op4_best_fit_packing": _on_documents(packing.op4),
        "op5_quality_classifier": quality_model.op5,
        "op6_line_dedup": _on_documents(line_dedup.op6),
        "op7_simhash_near_dedup": _on_documents(simhash.op7),
        "op8_hilbert_shards": _on_documents(hilbert.op8),
        "op9_quality_rules": _on_documents(quality_rules.op9),
        "op10_token_rollups": _on_documents(rollups.op10),
        "op11_lexical_search": lexical_search.op11,
        "op12_warc_capture_index": warc.op12,
        "op13_phrase_collocations": _on_documents(collocations.op13),
        "llm_word_rollups": _on_documents(rollups.word_rollups),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_line_dedup": line_dedup.ORACLE,
        "op8_hilbert_shards": hilbert.oracle(),
        "op9_quality_rules": quality_rules.ORACLE,
        "op11_lexical_search": lexical_search.ORACLE,
        "op12_warc_capture_index": warc.ORACLE,
        "op13_phrase_collocations": collocations.ORACLE,
        "llm_word_rollups": rollups.WORD_ORACLE,
    }
