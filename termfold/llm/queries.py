"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termfold.llm import ann, bpe_count, bpe_tree, jaccard, main_text, mixing, pii, prefix_trie, quality, sharding, simhash, token_files, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": quality.op1_quality,
    "op2_jaccard": jaccard.op2_jaccard,
    "op3_pii": pii.op3_pii,
    "op4_main_text": main_text.op4_main_text,
    "op5_mixing": mixing.op5_mixing,
    "op6_bpe": bpe_tree.op6_bpe,
    "op7_token_counts": bpe_count.op7_token_counts,
    "op8_token_files": token_files.op8_token_files,
    "op9_simhash": simhash.op9_simhash,
    "op10_ann": ann.op10_ann,
    "op11_sharding": sharding.op11_sharding,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op2_jaccard": jaccard.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
