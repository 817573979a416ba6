"""The queries of the text operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from regchron.llm import (
    chat,
    decontaminate,
    lm,
    near_text,
    near_vectors,
    phrases,
    pii,
    quality,
    repeats,
    secrets,
    sentencepieces,
    substrings,
    whitening,
)

QUERIES = {
    "op1_secrets": secrets.op1,
    "op2_sentencepieces": sentencepieces.op2,
    "op3_pii": pii.op3,
    "op4_near_text": near_text.op4,
    "op5_near_vectors": near_vectors.op5,
    "op6_chat": chat.op6,
    "op7_quality": quality.op7,
    "op8_decontaminate": decontaminate.op8,
    "op9_repeats": repeats.op9,
    "op10_lm": lm.op10,
    "op11_substrings": substrings.op11,
    "op12_phrases": phrases.op12,
    "op13_whitening": whitening.op13,
}

ORACLE = {
    "op1_secrets": secrets.SQL,
    "op5_near_vectors": near_vectors.SQL,
    "op6_chat": chat.SQL,
    "op8_decontaminate": decontaminate.SQL,
    "op9_repeats": repeats.SQL,
    "op11_substrings": substrings.SQL,
    "op12_phrases": phrases.SQL,
}
