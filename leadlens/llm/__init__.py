"""Operators for large training-text pipelines: one module per operator.

Each module has a general operator (DataFrame in, DataFrame out) and the thin
query ``opN_<name>`` over the given tables.  ``queries()`` and ``oracle_sql()``
collect them; nothing outside this package imports it except
``__spark_entry__.py``.
"""

from __future__ import annotations


def _modules():
    from leadlens.llm import (
        conversation_trie, exact_dedup, html_extract, language_id, license_scan, line_quality, mixing, ngram_join,
        phrase_mining, sentencepiece_sampling, suffix_tree_lm, topk, warc_revisit)
    return (license_scan, html_extract, ngram_join, language_id, mixing, line_quality, topk,
            sentencepiece_sampling, warc_revisit, suffix_tree_lm, conversation_trie, phrase_mining, exact_dedup)


def queries() -> dict:
    """``opN_<name>`` -> callable (spark, sf_dir) -> DataFrame."""
    out = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    out = {}
    for m in _modules():
        out.update(getattr(m, "ORACLE", {}))
    return out
