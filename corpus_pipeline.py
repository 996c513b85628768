"""A corpus pipeline of five stages, each calling one operator of the llm package.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet to the shared folder and rereads it as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarmill.llm.common import read, stored
from bazaarmill.llm.curriculum import curriculum_stage
from bazaarmill.llm.decontaminate import decontaminate_stage
from bazaarmill.llm.langid import language_stage
from bazaarmill.llm.simhash import simhash_stage
from bazaarmill.llm.tokenids import token_stage

STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontaminate_stage),
    ("curriculum_mix", curriculum_stage),
    ("token_ids", token_stage),
]

#: No SQL: tokenization, fingerprints and trained classifiers have none; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
