"""The registered queries of the training-data operators, and their SQL where there is one."""

from __future__ import annotations

from personpub.llm import (
    chat,
    decontamination,
    divergence,
    exact_dedup,
    fill_middle,
    jaccard,
    language_id,
    secrets,
    sentencepiece,
    sharding,
    toxicity,
    url_filter,
    warc,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_chat_format": chat.op5_chat_format,
    "op6_sentencepiece": sentencepiece.op6_sentencepiece,
    "op7_language_id": language_id.op7_language_id,
    "op8_jaccard_join": jaccard.op8_jaccard_join,
    "op9_sharding": sharding.op9_sharding,
    "op10_warc": warc.op10_warc,
    "op11_secrets": secrets.op11_secrets,
    "op12_fill_middle": fill_middle.op12_fill_middle,
    "op13_divergence": divergence.op13_divergence,
}

SQL = {
    "op2_url_filter": url_filter.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op4_decontamination": decontamination.SQL,
    "op11_secrets": secrets.op11_secrets,
    "op12_fill_middle": fill_middle.SQL,
    "op13_divergence": divergence.SQL,
}
