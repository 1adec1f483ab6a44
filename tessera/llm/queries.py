"""The operators' queries and their SQL, by name."""

from __future__ import annotations

from . import ann, audit, bpe, dialogue, licenses, lines, mixing, near, packing, topk, toxicity, urls

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_packing": packing.op2_packing,
    "op3_token_output": packing.op3_token_output,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_topk": topk.op5_topk,
    "op6_near_dedup": near.op6_near_dedup,
    "op7_ann": ann.op7_ann,
    "op8_line_dedup": lines.op8_line_dedup,
    "op9_url_filter": urls.op9_url_filter,
    "op10_licenses": licenses.op10_licenses,
    "op11_bpe": bpe.op11_bpe,
    "op12_conversation_repair": dialogue.op12_conversation_repair,
    "op13_filter_audit": audit.op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op5_topk": topk.SQL,
    "op8_line_dedup": lines.SQL,
    "op10_licenses": licenses.SQL,
    "op12_conversation_repair": dialogue.SQL,
    "op13_filter_audit": audit.SQL,
}
