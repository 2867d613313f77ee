"""All registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from stayframe.llm import (
    q_bitslice,
    q_bpe,
    q_chat,
    q_html,
    q_mixing,
    q_phrases,
    q_pii,
    q_quality,
    q_sharding,
    q_simhash,
    q_spelling,
    q_toxicity,
    q_trie,
)

_MODULES = (q_pii, q_toxicity, q_chat, q_html, q_phrases, q_simhash, q_mixing, q_quality, q_bitslice, q_bpe,
            q_sharding, q_trie, q_spelling)

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE = {k: v for m in _MODULES for k, v in m.ORACLE.items()}
