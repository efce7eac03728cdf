"""The operators' registered queries and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from . import (
    op1_mix,
    op2_topk,
    op3_pii,
    op4_sketch,
    op5_near_dedup,
    op6_bpe,
    op7_html,
    op8_license,
    op9_lines,
    op10_language,
    op11_turn_repair,
    op12_prefix_trie,
    op13_prefix_bpe,
)

LLM_QUERIES = {
    "op1_mix_sources": op1_mix.op1_mix_sources,
    "op2_topk": op2_topk.op2_topk,
    "op3_pii_surrogates": op3_pii.op3_pii_surrogates,
    "op4_fingerprints": op4_sketch.op4_fingerprints,
    "op5_near_dedup": op5_near_dedup.op5_near_dedup,
    "op6_byte_bpe": op6_bpe.op6_byte_bpe,
    "op7_html_extract": op7_html.op7_html_extract,
    "op8_license_scan": op8_license.op8_license_scan,
    "op9_line_dedup": op9_lines.op9_line_dedup,
    "op10_language_id": op10_language.op10_language_id,
    "op11_turn_repair": op11_turn_repair.op11_turn_repair,
    "op12_prefix_trie": op12_prefix_trie.op12_prefix_trie,
    "op13_prefix_bpe": op13_prefix_bpe.op13_prefix_bpe,
    "pipeline": corpus_pipeline.run,
}
LLM_ORACLE = {
    "op1_mix_sources": op1_mix.SQL,
    "op2_topk": op2_topk.SQL,
    "op9_line_dedup": op9_lines.SQL,
    "op11_turn_repair": op11_turn_repair.SQL,
    "op12_prefix_trie": op12_prefix_trie.SQL,
}
