"""The corpus pipeline: its stages in order, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import stages
from tillflow.llm.scratch import stored

#: (name, function of (spark, docs, sf_dir)); all but the last return the columns of documents.
STAGES = [
    ("language_id", stages.language_id),
    ("exact_dedup", stages.exact_dedup),
    ("near_dedup", stages.near_dedup),
    ("decontamination", stages.decontaminate),
    ("sentencepiece", stages.sentencepiece),
]

#: SQL has neither SentencePiece nor the fitted language model; tests compare every stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
