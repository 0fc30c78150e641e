"""The operators as registered queries over whole tables, and their SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm import bpe, centroids, chat, classifier, licenses, nearest, packing, quality, runs, secrets, similarity, url_filter, warc
from concordat.llm.oracles import ORACLES
from concordat.sources.tables import table

__all__ = ["ORACLES", "QUERIES", "vocabulary"]
Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats every conversation, and one whose texts hold control strings."""
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.format_conversations(rows)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_and_index(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "warc_date")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), vocabulary())


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.linked(table(spark, sf_dir, "documents"), k=3, num=9, den=10)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_candidates", "n_secrets", "secrets", F.sha2(F.coalesce("redacted", F.lit("")), 256).alias("redacted_sha256"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which some are made periodic, as the query's contract says."""
    return runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=runs.tenth_made_periodic)


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_chat_formatting, op2_best_fit_packing, op3_warc, op4_bpe, op5_quality_rules, op6_ngram_jaccard_join, op7_license_scan, op8_secret_scan, op9_url_filter, op10_nearest_neighbours, op11_centroid_clustering, op12_periodic_runs, op13_quality_classifier)}
