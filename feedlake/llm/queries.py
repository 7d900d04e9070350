"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from feedlake.llm import hmm, idfiles, jaccard, langid, lines, packing, pieces, quality, secrets, simhash, suffixes, trie, whitening

QUERIES = {
    "op1_lm": hmm.q_lm,
    "op2_suffixes": suffixes.q_suffixes,
    "op3_line_dedup": lines.q_line_dedup,
    "op4_jaccard": jaccard.q_jaccard,
    "op4_links": jaccard.q_links,
    "op5_secrets": secrets.q_secrets,
    "op6_simhash": simhash.q_simhash,
    "op6_neighbours": simhash.q_neighbours,
    "op7_langid": langid.q_langid,
    "op8_quality": quality.q_quality,
    "op9_packing": packing.q_packing,
    "op10_pieces": pieces.q_pieces,
    "op11_tokens": idfiles.q_tokens,
    "op12_trie": trie.q_trie,
    "op13_whitening": whitening.q_whitening,
}
ORACLE = {
    "op8_quality": quality.QUALITY_SQL,
    "op3_line_dedup": lines.LINE_DEDUP_SQL,
    "op12_trie": trie.TRIE_SQL,
}
