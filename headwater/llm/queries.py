"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from headwater.llm import chat, decontaminate, html_text, jaccard, lm, neardup, packing, quality, ranked, repair, substring, token_files, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_ngram_jaccard_join": jaccard.op2_ngram_jaccard_join,
    "op3_token_output": token_files.op3_token_output,
    "op4_lm_scoring": lm.op4_lm_scoring,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_html_extraction": html_text.op6_html_extraction,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_embedding_neardup": neardup.op8_embedding_neardup,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_chat_format": chat.op10_chat_format,
    "op11_substring_dedup": substring.op11_substring_dedup,
    "op12_ranked_search": ranked.op12_ranked_search,
    "op13_conversation_repair": repair.op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": jaccard.OP2_SQL,
    "op7_decontamination": decontaminate.OP7_SQL,
    "op8_embedding_neardup": neardup.OP8_SQL,
    "op10_chat_format": chat.OP10_SQL,
    "op11_substring_dedup": substring.OP11_SQL,
    "op12_ranked_search": ranked.OP12_SQL,
}
