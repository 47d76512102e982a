"""Queries of the operators in this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from millrace.llm import op1_chat, op2_order_minhash, op3_toxicity, op4_ogg, op5_url_rules, op6_rule_ledger, op7_retrieval_packing, op8_bpe, op9_mincut, op10_line_frequency, op11_collocations, op12_whitening, op13_learned_partitions

QUERIES = {
    "op1_chat_rotation": op1_chat.op1_chat_rotation,
    "op2_order_minhash": op2_order_minhash.op2_order_minhash,
    "op3_toxicity_grammar": op3_toxicity.op3_toxicity_grammar,
    "op4_ogg_samples": op4_ogg.op4_ogg_samples,
    "op5_url_association_rules": op5_url_rules.op5_url_association_rules,
    "op6_rule_ledger": op6_rule_ledger.op6_rule_ledger,
    "op7_retrieval_packing": op7_retrieval_packing.op7_retrieval_packing,
    "op8_two_tier_bpe": op8_bpe.op8_two_tier_bpe,
    "op9_mincut_extraction": op9_mincut.op9_mincut_extraction,
    "op10_site_line_frequency": op10_line_frequency.op10_site_line_frequency,
    "op11_collocations": op11_collocations.op11_collocations,
    "op12_whitening": op12_whitening.op12_whitening,
    "op13_learned_partitions": op13_learned_partitions.op13_learned_partitions,
}
ORACLE_SQL = {
    "op1_chat_rotation": op1_chat.OP1_SQL,
    "op6_rule_ledger": op6_rule_ledger.OP6_SQL,
    "op10_site_line_frequency": op10_line_frequency.OP10_SQL,
    "op11_collocations": op11_collocations.OP11_SQL,
}
