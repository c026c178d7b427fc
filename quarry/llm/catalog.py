"""Queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from . import (op01_suffix_array, op02_exact_dedup, op03_sentencepiece, op04_language, op05_warc, op06_substring,
               op07_lm, op08_decontaminate, op09_secrets, op10_minhash, op11_alignment,
               op12_jaccard_join, op13_prefix_trie)

OPS = {
    "op1_suffix_array_dedup": op01_suffix_array,
    "op2_exact_dedup": op02_exact_dedup,
    "op3_sentencepiece": op03_sentencepiece,
    "op4_language": op04_language,
    "op5_warc": op05_warc,
    "op6_substring_dedup": op06_substring,
    "op7_lm_scoring": op07_lm,
    "op8_decontaminate": op08_decontaminate,
    "op9_secrets": op09_secrets,
    "op10_minhash_near_dedup": op10_minhash,
    "op11_token_alignment": op11_alignment,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_prefix_trie": op13_prefix_trie,
}


def queries():
    return {name: m.query for name, m in OPS.items()}


def oracles():
    return {name: m.SQL for name, m in OPS.items() if m.SQL}
