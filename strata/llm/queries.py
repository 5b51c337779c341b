"""Registered queries of this subpackage and their DuckDB SQL, where it exists."""
from __future__ import annotations

from strata.llm import (divergence, filter_audit, host_reputation, line_crf, mixing, multi_index, ngram_join, piece_codec,
                        secret_scan, slot_shards, template_slots, toxicity, whitening)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_divergence": divergence.op2_divergence,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_template_slots": template_slots.op4_template_slots,
    "op5_multi_index": multi_index.op5_multi_index,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_host_reputation": host_reputation.op7_host_reputation,
    "op8_piece_codec": piece_codec.op8_piece_codec,
    "op9_line_crf": line_crf.op9_line_crf,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_whitening": whitening.op12_whitening,
    "op13_slot_shards": slot_shards.op13_slot_shards,
}

ORACLE = {
    "op1_mix_sources": mixing.SQL,
    "op7_host_reputation": host_reputation.SQL,
    "op11_filter_audit": filter_audit.SQL,
}
