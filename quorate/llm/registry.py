"""The subpackage's queries and their SQL."""

from quorate.llm import bpe, chat_format, decontam, html_extract, lm_score, ngram_join, quality_rules, rk_dedup, sa_dedup, secret_scan

QUERIES = {
    "op1_quality_rules": quality_rules.op1,
    "op2_ngram_join": ngram_join.op2,
    "op3_chat_format": chat_format.op3,
    "op4_byte_bpe": bpe.op4,
    "op5_secret_scan": secret_scan.op5,
    "op6_decontaminate": decontam.op6,
    "op7_lm_score": lm_score.op7,
    "op8_html_extract": html_extract.op8,
    "op9_substring_dedup": rk_dedup.op9,
    "op10_suffix_dedup": sa_dedup.op10,
}

ORACLES = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op2_ngram_join": ngram_join.ORACLE,
    "op3_chat_format": chat_format.ORACLE,
    "op9_substring_dedup": rk_dedup.ORACLE,
}
