"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from tidemark.llm import (
    q01_licenses,
    q02_html_text,
    q03_toxicity,
    q04_token_files,
    q05_near_dups,
    q06_bpe,
    q07_suffix_dedup,
    q08_top_k,
    q09_chat_format,
    q10_decontaminate,
    q11_prefix_trie,
    q12_quality_rules,
    q13_hard_negatives,
)

_MODULES = (
    q01_licenses, q02_html_text, q03_toxicity, q04_token_files, q05_near_dups, q06_bpe, q07_suffix_dedup, q08_top_k, q09_chat_format, q10_decontaminate,
    q11_prefix_trie, q12_quality_rules, q13_hard_negatives,
)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
