"""From raw documents to token ids: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordflow.llm.bpe import encoded_stage
from recordflow.llm.common import staged, table
from recordflow.llm.mixing import mixed_stage
from recordflow.llm.neardup import deduplicated_stage
from recordflow.llm.recompress import deduplicated_words_stage
from recordflow.llm.toxicity import clean_stage

#: (name, function of the session, the documents so far and the folder of the tables).
STAGES = [
    ("toxicity", clean_stage),
    ("near_duplicates", deduplicated_stage),
    ("substrings", deduplicated_words_stage),
    ("mixing", mixed_stage),
    ("byte_bpe", encoded_stage),
]

#: Hashes, fitted weights and merges are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
