"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from wayline.llm import q_bpe, q_chat, q_hilbert, q_interactions, q_minhash, q_mixing, q_planes, q_repeats, q_secrets, q_topk, q_toxicity, q_tries, q_wrapper

QUERIES = {
    "op1_secrets": q_secrets.op1_secrets,
    "op2_minhash": q_minhash.op2_minhash,
    "op3_bpe": q_bpe.op3_bpe,
    "op4_chat": q_chat.op4_chat,
    "op5_suffix_array": q_repeats.op5_suffix_array,
    "op6_mixing": q_mixing.op6_mixing,
    "op7_html": q_wrapper.op7_html,
    "op8_hilbert": q_hilbert.op8_hilbert,
    "op9_toxicity": q_toxicity.op9_toxicity,
    "op10_topk": q_topk.op10_topk,
    "op11_filter_audit": q_interactions.op11_filter_audit,
    "op12_bit_planes": q_planes.op12_bit_planes,
    "op13_prefix_trie": q_tries.op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op1_secrets": q_secrets.ORACLE,
    "op4_chat": q_chat.ORACLE,
    "op10_topk": q_topk.ORACLE,
    "op11_filter_audit": q_interactions.ORACLE,
    "op13_prefix_trie": q_tries.ORACLE,
}
