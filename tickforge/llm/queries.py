"""The numbered queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decision_list, decontaminate, html_extraction, importance_resampling, mixing, ngram_jaccard, ordinal_toxicity, piece_ids, prefix_trie, repair_ids, suffix_dedup, viterbi_counts, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ordinal_toxicity": ordinal_toxicity.query,
        "op2_repair_ids": repair_ids.query,
        "op3_ngram_jaccard": ngram_jaccard.query,
        "op4_suffix_dedup": suffix_dedup.query,
        "op5_warc": warc.query,
        "op6_decontaminate": decontaminate.query,
        "op7_decision_list": decision_list.query,
        "op8_viterbi_counts": viterbi_counts.query,
        "op9_mixing": mixing.query,
        "op10_html_extraction": html_extraction.query,
        "op11_importance_resampling": importance_resampling.query,
        "op12_piece_ids": piece_ids.query,
        "op13_prefix_trie": prefix_trie.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_ngram_jaccard": ngram_jaccard.SQL,
        "op5_warc": warc.SQL,
        "op6_decontaminate": decontaminate.SQL,
        "op11_importance_resampling": importance_resampling.SQL,
        "op13_prefix_trie": prefix_trie.SQL,
    }
