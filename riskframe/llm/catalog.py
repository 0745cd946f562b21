"""Registered queries of the operators and the SQL of those that SQL can express."""

from __future__ import annotations

from riskframe.llm import chat, decontam, embeddings, jaccard, lines, mixing, phrases, pii, quality, suffixes, toxicity, warc, whitening

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_near_vectors": embeddings.op2_near_vectors,
    "op3_chat_format": chat.op3_chat_format,
    "op4_suffix_dedup": suffixes.op4_suffix_dedup,
    "op5_ngram_jaccard": jaccard.op5_ngram_jaccard,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_warc": warc.op7_warc,
    "op8_private": pii.op8_private,
    "op9_decontaminate": decontam.op9_decontaminate,
    "op10_line_dedup": lines.op10_line_dedup,
    "op11_quality": quality.op11_quality,
    "op12_whitening": whitening.op12_whitening,
    "op13_phrases": phrases.op13_phrases,
}
ORACLE = {
    "op1_mix_sources": mixing.oracle(),
    "op3_chat_format": chat.ORACLE,
    "op7_warc": warc.ORACLE,
    "op9_decontaminate": decontam.ORACLE,
    "op13_phrases": phrases.ORACLE,
}
