"""The operators' registered queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.byte_bpe import op10_byte_level_bpe
from starloom.llm.chat import ORACLE_OP1, op1_chat_formatting
from starloom.llm.decontaminate import op3_benchmark_decontamination
from starloom.llm.jaccard import op4_ngram_jaccard_join
from starloom.llm.passages import ORACLE_OP8, op8_line_dedup
from starloom.llm.pii import op5_pii_pseudonyms
from starloom.llm.quality import op6_quality_rules
from starloom.llm.repair import op13_conversation_repair
from starloom.llm.token_files import op7_token_id_files
from starloom.llm.toxicity import op12_toxicity
from starloom.llm.url_rules import ORACLE_OP9, op9_url_filters
from starloom.llm.variants import op11_spelling_variants
from starloom.llm.warc import ORACLE_OP2, op2_warc_salvage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_warc_salvage": op2_warc_salvage,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_pii_pseudonyms": op5_pii_pseudonyms,
    "op6_quality_rules": op6_quality_rules,
    "op7_token_id_files": op7_token_id_files,
    "op8_line_dedup": op8_line_dedup,
    "op9_url_filters": op9_url_filters,
    "op10_byte_level_bpe": op10_byte_level_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_toxicity": op12_toxicity,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op1_chat_formatting": ORACLE_OP1,
    "op2_warc_salvage": ORACLE_OP2,
    "op8_line_dedup": ORACLE_OP8,
    "op9_url_filters": ORACLE_OP9,
}
