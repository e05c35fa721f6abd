"""Stages of the corpus pipeline: operators whose verdicts take effect on the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as decontaminating
from . import exact, jaccard, language, pieces
from .scratch import stored


#: A column that stages add and take away again.
ROW_NAME = "__row_name"


def row_name() -> Column:
    """Names a row by doc_id and text; rows that repeat both share it."""
    return F.concat_ws(" ", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language stays in doubt, go."""
    model = language.fit(docs)
    named = docs.withColumn(ROW_NAME, row_name())
    found = language.identify(named, model, ROW_NAME, "text", host=F.col("source"))
    rejected = stored(found.where(~F.col("accepted")).select(ROW_NAME).distinct(), "rejected")
    return named.join(rejected, ROW_NAME, "left_anti").select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the most code points stays, then the smallest doc_id, then text fingerprint.

    Rows that repeat a doc_id and a text are one row afterwards, that with the
    smallest other columns.  The rows' order doesn't matter.
    """
    name = lambda key, text: F.concat_ws(" ", key, text)  # noqa: E731  null keys are left out and equal each other
    verdicts = exact.duplicates(docs).groupBy(name("doc_id", "text_print").alias(ROW_NAME)).agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    special = stored(verdicts.where("NOT kept OR n > 1"), "special")
    named = docs.withColumn(ROW_NAME, name("doc_id", exact.tag_of("text")))
    once = named.join(special.select(ROW_NAME), ROW_NAME, "left_anti").select(docs.columns)
    repeated = named.join(special.where("kept").select(ROW_NAME), ROW_NAME, "left_semi")
    return once.unionByName(repeated.groupBy(ROW_NAME).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 80 % similar five-word shingles connect, the one with the smallest doc_id stays."""
    name = lambda key, text: F.concat_ws(" ", key, text)  # noqa: E731  null keys are left out and equal each other
    gone = jaccard.similar(docs).where("NOT stays").select(name("doc_id", "text_print").alias(ROW_NAME)).distinct()
    named = docs.withColumn(ROW_NAME, name("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))))
    return named.join(gone, ROW_NAME, "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % of the five-word shingles of a benchmark item go."""
    return decontaminating.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids and decoded texts."""
    import public_tokenizers

    return pieces.encode(docs, pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model")))
