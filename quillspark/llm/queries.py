"""Queries of the training-data operators, by name; SQL where DuckDB can express them."""

from __future__ import annotations

from quillspark.llm import bpe, chat, exact_dedup, fingerprint, html, mixing, ngram_join, pii, quality, tokens

QUERIES = {
    "op1_html": html.op1_html,
    "op2_pii": pii.op2_pii,
    "op3_mixing": mixing.op3_mixing,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_quality": quality.op5_quality,
    "op6_token_counts": tokens.op6_token_counts,
    "op7_bpe": bpe.op7_bpe,
    "op8_fingerprints": fingerprint.op8_fingerprints,
    "op9_chat": chat.op9_chat,
    "op10_ngram_join": ngram_join.op10_ngram_join,
}

ORACLES = {"op3_mixing": mixing.OP3_SQL, "op4_exact_dedup": exact_dedup.OP4_SQL}
