"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contained

    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .style_tree import main_text

    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op3_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .recompression import without_repeats

    return without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc_zip import archived

    return archived(table(spark, sf_dir, "pages"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact import duplicates

    return duplicates(table(spark, sf_dir, "documents")).drop("text_print")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_parts import STRONG, listing, spans

    strong = F.filter("found", lambda x: x["strong"])
    of_kind = lambda kind: F.filter("found", lambda x: x["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in STRONG]
    return spans(table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(listing(strong), 256).alias("base_sha256"), listing(F.col("found")).alias("spans")
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .pieces import encode, model_bytes

    rows = encode(table(spark, sf_dir, "documents"), model_bytes(public_tokenizers.path("piece_bpe_32k.model")))
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import similar

    return similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import fit, identify

    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs), "doc_id", "text", host=F.col("source"))
    return found.withColumnRenamed("accepted", "kept")


def op9_page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, with what its markup declares and its address; the language of its text is told by the documents."""
    from .language import fit, host_of, identify, markup_language, suffix_of, visible_text

    html, url = F.col("html"), F.col("url")
    found = identify(
        table(spark, sf_dir, "pages"), fit(table(spark, sf_dir, "documents")), "page_id", visible_text(html),
        declared=markup_language(html), host=host_of(url), suffix=suffix_of(url),
    )
    return found.withColumnRenamed("accepted", "kept")


def op10_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that repeat a passage of a document with a smaller doc_id, and what is left of them."""
    from .sparse_suffixes import without_repeats

    found = without_repeats(table(spark, sf_dir, "documents")).where("n_removed > 0")
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, scored

    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .clustering import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit, cells

    return audit(cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def build() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_html_text": op2_html_text,
        "op3_recompression_dedup": op3_recompression_dedup,
        "op4_warc": op4_warc,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_secrets": op6_secrets,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_language_id": op9_language_id,
        "op10_sparse_suffixes": op10_sparse_suffixes,
        "op11_toxicity": op11_toxicity,
        "op12_clustering": op12_clustering,
        "op13_filter_audit": op13_filter_audit,
    }


def further() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries of an operator over a second table."""
    return {"op9_page_language_id": op9_page_language_id}
