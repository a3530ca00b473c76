"""The corpus pipeline: from raw documents to token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.common import stored, table
from tallyloom.llm.decontaminate import clean_stage
from tallyloom.llm.mixing import mix_stage
from tallyloom.llm.simhash import one_of_each
from tallyloom.llm.tokens import token_stage
from tallyloom.llm.toxicity import ordinary_stage

STAGES = [
    ("toxicity", ordinary_stage),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", clean_stage),
    ("mixing", mix_stage),
    ("token_ids", token_stage),
]

#: SQL can't express the stages: learnt models, tokenizers and approximate matching.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: doc_id, start, n_tokens, ids_crc32 of each document in the token files."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
