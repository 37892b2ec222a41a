"""Registered queries of the training-data operators and their SQL."""

from gridcast.llm import (chat_format, decontaminate, exact_dedup, hard_negatives, html_extract, langid, mixing, near_dup,
                          quality, sharding, simhash, url_filter, whitening)

QUERIES = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_ngram_jaccard_join": near_dup.op2_ngram_jaccard_join,
    "op3_mixing": mixing.op3_mixing,
    "op4_sharding": sharding.op4_sharding,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_chat_format": chat_format.op6_chat_format,
    "op7_benchmark_decontamination": decontaminate.op7_benchmark_decontamination,
    "op8_html_extraction": html_extract.op8_html_extraction,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_language_id": langid.op10_language_id,
    "op11_simhash": simhash.op11_simhash,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_whitening": whitening.op13_whitening,
}
ORACLE = {
    "op3_mixing": mixing.OP3_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op6_chat_format": chat_format.OP6_SQL,
    "op7_benchmark_decontamination": decontaminate.OP7_SQL,
    "op9_url_filter": url_filter.OP9_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
}
