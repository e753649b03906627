"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import (byte_bpe, html_text, id_files, lexical, line_dedup, mixing, ngram_join, personal_data, prefix_trie, quality_rules,
               suffix_dedup, top_k, unit_dedup)


def queries() -> dict:
    return {
        "op1_suffix_dedup": suffix_dedup.query,
        "op2_mixing": mixing.query,
        "op3_unit_dedup": unit_dedup.query,
        "op4_ngram_join": ngram_join.query,
        "op5_byte_bpe": byte_bpe.query,
        "op6_id_files": id_files.query,
        "op7_quality_rules": quality_rules.query,
        "op8_html_text": html_text.query,
        "op9_line_dedup": line_dedup.query,
        "op10_top_k": top_k.query,
        "op11_prefix_trie": prefix_trie.query,
        "op12_personal_data": personal_data.query,
        "op13_lexical": lexical.query,
    }


def oracles() -> dict[str, str]:
    return {"op4_ngram_join": ngram_join.ORACLE, "op9_line_dedup": line_dedup.ORACLE, "op10_top_k": top_k.ORACLE,
            "op11_prefix_trie": prefix_trie.ORACLE, "op13_lexical": lexical.ORACLE}
