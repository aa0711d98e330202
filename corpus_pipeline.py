"""From raw documents to token ids: five stages, each over all that the one before it kept.

Documents that the quality rules reject go; one document of each near-duplicate class stays;
documents that hold a test item go; personal data becomes pseudonyms; texts are encoded. All
stages but the last return the columns of ``documents``. ``run`` writes every stage's result to
the shared folder and reads it back.

An empty table passes through all stages; nulls, ties, repeated rows and other columns are
treated as each operator's module says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.byte_bpe import encode_stage
from starloom.llm.common import table, written
from starloom.llm.decontaminate import drop_leaks
from starloom.llm.jaccard import one_of_each
from starloom.llm.pii import hide_private
from starloom.llm.quality import keep_good

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", drop_leaks),
    ("pii", hide_private),
    ("byte_level_bpe", encode_stage),
]

#: SQL has no Kneser-Ney model, Feistel network or BPE; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
