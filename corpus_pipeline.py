"""The corpus pipeline: toxicity, near duplicates, personal data, packing.

Each stage works on all that its predecessor kept. Toxic documents go, one document of
each class of near copies stays, personal data is generalised within the texts, and what
remains is packed into windows of tokens. A stage's result is written to the shared
folder and read again, so that a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressmill.llm.disclosure import clean_texts
from pressmill.llm.lsh_forest import keep_one
from pressmill.llm.nnls_packing import pack_stage
from pressmill.llm.toxicity import drop_toxic
from pressmill.session import written

STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one),
    ("personal_data", clean_texts),
    ("packing", pack_stage),
]

#: Boosted trees and tokenising have no SQL; tests/llm compares with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
