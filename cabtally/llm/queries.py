"""The registered queries of the numbered operators, and their SQL where there is one."""

from __future__ import annotations

from cabtally.llm import (
    bpe,
    chat,
    divergence,
    embeddings,
    exact_dedup,
    html_text,
    mixing,
    prefix_trie,
    quality,
    simhash,
    token_counts,
    toxicity,
    warc,
)

QUERIES = {
    "op1_warc_transactions": warc.op1_warc_transactions,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_bpe_round_trip": bpe.op4_bpe_round_trip,
    "op5_embedding_near_dups": embeddings.op5_embedding_near_dups,
    "op6_html_text": html_text.op6_html_text,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_simhash_near_dedup": simhash.op8_simhash_near_dedup,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_chat_format": chat.op10_chat_format,
    "op11_divergence_audit": divergence.op11_divergence_audit,
    "op12_quality_rules": quality.op12_quality_rules,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

#: The others have no equivalent in SQL; tests compare them with brute force.
ORACLE = {
    "op1_warc_transactions": warc.SQL,
    "op2_mix_sources": mixing.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op10_chat_format": chat.SQL,
    "op11_divergence_audit": divergence.SQL,
    "op12_quality_rules": quality.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
